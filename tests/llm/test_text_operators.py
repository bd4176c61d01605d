"""The text operators on small tables: against brute force, exact round trips
and the edge cases their docstrings define."""

import hashlib
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftframe.llm import bpe, chat, hmm, minhash, mixing, quality, queries, substrings, toxicity, urls, vectors
from siftframe.llm.components import connected_components

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"


def words(n, seed=0, size=400):
    draw = np.random.default_rng(seed)
    return [f"w{k}" for k in draw.integers(0, size, n)]


# --- encoding -------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(PATH)


TEXTS = [
    None, "", " ", "Hello world's  end\n\n\tx", "é漢字🙂 ½", "<|endoftext|>a<|endoftext|>", "a" * 3000, "x y" * 500,
    "the <|endo", "ab\u00a0\u3000cd", "12 345th 6",
]


def test_encoding_equals_the_library_and_decodes_to_the_text(spark, vocabulary):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again")]
    df = spark.createDataFrame(rows, DOCS + ", ids string")
    found = bpe.decode(bpe.encode(df, vocabulary), vocabulary, into="decoded").collect()
    library = Tokenizer.from_file(PATH)
    assert len(found) == len(rows)
    for r in found:
        text = TEXTS[r["doc_id"]] or ""
        expected = library.encode(text, add_special_tokens=False).ids
        assert list(array("I", r["ids"])) == expected
        assert r["decoded"] == library.decode(expected, skip_special_tokens=False) == text


def test_long_words_merge_as_short_ones(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    word = "".join(np.random.default_rng(1).choice(list("abcdehilnorst"), 700)).encode()
    assert encoder.merge(word) == encoder.merge_long(word)
    assert encoder.merge(b"") == encoder.merge_long(b"") == []


def test_encoding_of_an_empty_table_and_digests(spark, vocabulary):
    empty = spark.createDataFrame([], DOCS)
    assert bpe.digests(empty, vocabulary).count() == 0
    one = bpe.digests(spark.createDataFrame([(None, None)], DOCS), vocabulary).first()
    assert one["n_tokens"] == 0 and one["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    ids = bpe.encode(spark.createDataFrame([(1, "a b")], DOCS), vocabulary, packed=False).first()["ids"]
    assert ids == Tokenizer.from_file(PATH).encode("a b").ids


# --- language model -------------------------------------------------------


def test_forward_and_expected_counts_equal_enumeration():
    draw = np.random.default_rng(3)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    model = hmm.Model(norm(draw.random(2)), norm(draw.random((2, 2))), norm(draw.random((2, 4))).T)
    sequences = [np.array(s, np.uint16) for s in ([0, 1, 3], [2], [1, 1, 0, 2])]
    lattice = hmm.Lattice(sequences)
    starts, moves, emitted = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for s, got in zip(sequences, lattice.log_likelihoods(model), strict=True):
        paths = np.array(np.meshgrid(*[[0, 1]] * len(s))).reshape(len(s), -1).T
        p = [
            model.start[q[0]]
            * np.prod([model.moves[a, b] for a, b in zip(q, q[1:], strict=False)])
            * np.prod([model.emits[x, k] for x, k in zip(s, q, strict=True)])
            for q in paths
        ]
        assert got == pytest.approx(np.log10(sum(p)))
        for q, w in zip(paths, np.array(p) / sum(p), strict=True):
            starts[q[0]] += w
            for a, b in zip(q, q[1:], strict=False):
                moves[a, b] += w
            for x, k in zip(s, q, strict=True):
                emitted[x, k] += w
    for a, b in zip(lattice.expected(model), (starts, moves, emitted), strict=True):
        assert np.allclose(a, b)


def test_model_scores_beat_the_base_on_held_out_text(spark):
    rows = [(i, " ".join(words(120, i, 60) if i % 2 else [w.upper() + "x" for w in words(120, i, 60)])) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "w1 unseen"), (5, rows[5][1])]
    df = spark.createDataFrame(rows, DOCS).withColumn("held", F.col("doc_id") % 5 == 0)
    found = hmm.score(df, "held", states=3, rounds=8).collect()
    assert len(found) == len(rows)
    held = [r for r in found if r["held_out"] and r["n_tokens"] > 1]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    empty = [r for r in found if r["doc_id"] in (100, 101)]
    assert all(r["n_tokens"] == 1 and r["score"] < 0 for r in empty)
    assert hmm.score(df.where("false"), "held").count() == 0
    untrained = hmm.score(df.where("doc_id = 5").withColumn("held", F.lit(True)), "held").first()
    assert untrained["train_tokens"] == 0 and untrained["n_known"] == 0 and untrained["base_score"] == 0


# --- mixing ---------------------------------------------------------------


def test_raking_meets_all_targets():
    codes = np.array([[a, b] for a in range(2) for b in range(3)])
    tokens = np.array([100.0, 300, 50, 400, 100, 250])
    targets = [mixing.Target("a", {"x": 0.5, "y": 0.5}), mixing.Target("b", {"p": 0.3, "q": 0.4, "r": 0.3})]
    p = mixing.raked(codes, tokens, targets, 500)
    drawn = tokens * p
    assert p.max() <= 1
    assert [drawn[codes[:, 0] == k].sum() for k in range(2)] == pytest.approx([250, 250], rel=1e-6)
    assert [drawn[codes[:, 1] == k].sum() for k in range(3)] == pytest.approx([150, 200, 150], rel=1e-6)
    assert len(mixing.raked(codes[:0], tokens[:0], targets, 0)) == 0


def test_mixture_follows_shares_and_bears_nulls(spark):
    rows = [(i, "a" if i % 4 else "b", 10) for i in range(4000)] + [(None, None, None), (None, "a", 5)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    target = [mixing.Target("source", {"a": 0.5, "b": 0.5})]
    found = mixing.mixed(df, target, "n", 0.4)
    got = {r["source"]: r["n"] for r in found.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    assert got["a"] / (got["a"] + got["b"]) == pytest.approx(0.5, abs=0.04)
    assert sorted(map(str, found.collect())) == sorted(map(str, mixing.mixed(df, target, "n", 0.4).collect()))
    assert mixing.mixed(df.where("false"), target, "n", 0.4).count() == 0
    assert mixing.smoothed(df, "source", "n").shares["b"] > 0.25
    with pytest.raises(ValueError):
        mixing.Target("a", {"x": 0.7, "y": 0.7})


def test_mixture_keeps_unlisted_and_null_languages(spark):
    langs = ["en", "en", "en", "en", "en", "de", "fr", "es", "pl", "pl", None, None]
    rows = [(i, " ".join(words(10, i)), langs[i % 12], f"s{i // 12 % 2}") for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS + ", lang string, source string")
    found = queries.mix_documents(df, "n_tokens", "topic").collect()
    tokens = sum(r["n_tokens"] for r in found)
    share = {v: sum(r["n_tokens"] for r in found if r["lang"] == v) / tokens for v in set(langs)}
    assert share["en"] == pytest.approx(0.58 * 2 / 3, abs=0.04)
    assert share["pl"] == pytest.approx(1 / 6, abs=0.04) and share[None] == pytest.approx(1 / 6, abs=0.04)
    only = queries.mix_documents(df.withColumn("lang", F.lit(None).cast("string")), "n_tokens", "topic")
    assert only.count() == pytest.approx(1500, abs=150)


def test_every_source_has_its_target_on_driver_and_executors(spark, monkeypatch):
    df = spark.range(-1, 6000).selectExpr(
        "id AS doc_id", "if(id < 0, NULL, concat('s', id % 300)) AS source", "if(id div 300 % 5 = 0, 'b', 'a') AS lang", "10L AS n"
    )
    df = df.unionByName(spark.sql("SELECT -2L AS doc_id, 's1' AS source, NULL AS lang, NULL AS n"))
    target = [mixing.Target("lang", {"a": 0.7, "b": 0.3})]
    every = mixing.Smoothed("source")
    found = sorted(mixing.mixed(df, target, "n", 0.4, every=every).collect())
    chances = {r["source"]: r["probability"] for r in found if r["lang"] == "a" and r["source"]}
    assert len(chances) > 290 and max(chances.values()) == pytest.approx(min(chances.values()), rel=0.02)
    monkeypatch.setattr(mixing, "LOCAL_ROWS", 10)
    monkeypatch.setattr(mixing, "STAGED_ROUNDS", 2)
    spread = sorted(mixing.mixed(df, target, "n", 0.4, every=every).collect())
    assert [tuple(r)[:4] for r in spread] == [tuple(r)[:4] for r in found]
    assert [r["probability"] for r in spread] == pytest.approx([r["probability"] for r in found], rel=1e-9)


def test_topics_and_counts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "b b b c")], DOCS + "").withColumn("topic", F.lit("old"))
    found = {r["doc_id"]: r for r in mixing.with_topics(df).collect()}
    assert found[1]["topic"] == found[2]["topic"] == "none" and found[3]["n_tokens"] == 4
    assert found[3]["topic"].startswith("topic")


# --- vectors --------------------------------------------------------------


def test_vector_links_equal_brute_force(spark):
    draw = np.random.default_rng(5)
    base = draw.standard_normal((120, 16))
    near = base[:40] + 0.18 * draw.standard_normal((40, 16))
    chain = np.cumsum(np.vstack([base[:1], 0.22 * draw.standard_normal((30, 16))]), axis=0)
    table = np.vstack([base, near, chain, base[:5], 3 * base[5:8]])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(table)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, []), (904, [1.0, None]), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("n_links", F.lit(7))
    found = {r["vec_id"]: r for r in vectors.near_copies(df).collect()}
    unit = table / np.linalg.norm(table, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    part = list(range(len(table)))
    for _ in part:
        part = [min([part[i], *(part[j] for j in np.nonzero(linked[i])[0])]) for i in range(len(part))]
    for i in range(len(table)):
        assert (found[i]["n_links"], found[i]["component_id"]) == (linked[i].sum(), part[i])
        assert found[i]["kept"] == (part[i] == i)
    for r in odd[:5]:
        assert (found[r[0]]["n_links"], found[r[0]]["component_id"], found[r[0]]["kept"]) == (0, r[0], True)
    assert found[None]["n_links"] == 0 and not found[None]["kept"]
    assert vectors.near_copies(df.where("false")).count() == 0


def test_crowded_filters_are_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SPLIT", 7)
    draw = np.random.default_rng(6)
    table = draw.standard_normal(16) + 0.05 * draw.standard_normal((40, 16))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(table)], "vec_id long, embedding array<double>")
    assert {(r["n_links"], r["component_id"]) for r in vectors.near_copies(df).collect()} == {(39, 0)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, 1), (100, 2), (7, 7)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 10 for i in range(10, 61)} | {100: 1, 1: 1, 2: 1}


# --- chat -----------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def test_windows_keep_every_turn_and_train_each_target_once(spark):
    rows = [(1, 0, "system", "be <|brief|> \\ here")]
    rows += [(1, i, "user" if i % 2 else "assistant", "<|im_end|>" + "word " * (i % 23) + "\\n é\n") for i in range(1, 80)]
    rows += [(2, 0, "assistant", None), (2, None, None, "x"), (None, 3, "us\ner\\n", "null id"), (3, 0, "assistant", "z" * 9000), (3, 1, "user", "")]
    df = spark.createDataFrame(rows, TURNS).withColumn("window", F.lit("clash"))
    windows = chat.windows(df, chat.Budget(200, 60, 40)).cache()
    found = {r["conv_id"]: r for r in chat.digests(windows).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        target = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert found[conv]["n_turns"] == len(turns)
        assert found[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (found[conv]["loss_chars"], found[conv]["loss_sha256"]) == (len(target), hashlib.sha256(target.encode()).hexdigest())
    first = sorted((r for r in windows.collect() if r["conv_id"] == 1), key=lambda r: r["window"])
    assert len(first) > 3
    assert all(r["formatted"].startswith("<|im_start|>system\n") for r in first)
    assert all(r["n_context"] >= 2 for r in first[1:]) and first[0]["n_context"] == 0
    assert all(len(r["formatted"]) <= 4 * (200 + 60 + 40 + 60) for r in first)
    assert chat.digests(chat.windows(df.where("false"))).count() == 0


# --- quality --------------------------------------------------------------


def test_measurements_by_brute_force(spark):
    texts = [None, "", "a b c a b c a b c d", "# $% x\n\nline\nline\n \nLINE TWO", "é é é é", "x " * 60, " ".join(words(300, 2, 20))]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("n_words", F.lit("clash"))
    for r in quality.ledger(df).collect():
        text = texts[r["doc_id"]] or ""
        w = text.split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        covered = {i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(3)}
        lines = [x for x in text.split("\n") if x.strip()]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        assert r["n_repeat_words"] == len(covered) and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert (r["failures"] & quality.mask_of(quality.BASE) != 0) == (len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_words_end_at_ascii_white_space_only():
    found = dict(zip(quality.MEASURES, quality.measure("ab\u00a0cd \u00e9t\u00e9 x\u2003y\x1cz \u6f22".encode()), strict=True))
    assert (found["n_words"], found["n_alpha_words"]) == (4, 2)


def test_policies_and_ablations_come_from_the_ledger(spark):
    texts = ["x", " ".join(words(80, 3)), " ".join(words(80, 4)) + " #" * 30, "a b c " * 40]
    book = quality.ledger(spark.createDataFrame(list(enumerate(texts)), DOCS)).cache()
    kept = {r["doc_id"]: r["k"] for r in book.select("doc_id", quality.passes("2026-1").alias("k")).collect()}
    found = {(r["policy"], r["rule"]): r for r in quality.ablations(book).collect()}
    assert found["2026-1", "symbols"]["n_kept"] == sum(kept.values())
    assert found["2026-1", "symbols"]["n_only_here"] == 1
    assert found["base", "few_words"]["n_docs"] == 4 and found["base", "few_words"]["n_failing"] == 1
    assert quality.ablations(book.where("false")).count() == 0


# --- near copies ----------------------------------------------------------


def test_near_copies_are_grouped_and_others_left_alone(spark):
    base = {i: words(200, i) for i in range(12)}
    rows = [(i, " ".join(w)) for i, w in base.items()]
    edited = list(base[3])
    edited[50] = "other"
    rows += [(20, " ".join(edited)), (21, " ".join(base[3])), (22, "\n".join(base[3]).upper()), (None, " ".join(base[3]))]
    rows += [(30, None), (31, ""), (32, ""), (33, "two words"), (34, "two words"), (5, " ".join(base[5]))]
    rows += [(40, " ".join(base[7][:100] + words(100, 99)))]
    df = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("clash"))
    found = minhash.near_copies(df).collect()
    assert len(found) == len(rows)
    got = {r["doc_id"]: r["class_id"] for r in found}
    assert [got[i] for i in (3, 20, 21, 22)] == [3] * 4 and got[34] == got[33] == 33
    assert all(got[i] == i for i in (0, 1, 7, 30, 31, 32, 40, 5)) and got[None] is None
    assert all(r["kept"] == (r["class_id"] in (None, r["doc_id"])) for r in found)
    assert minhash.near_copies(df.where("false")).count() == 0


def test_crowded_bands_are_split_and_resolved(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SPLIT", 3)
    base = words(150, 1)
    rows = []
    for i in range(30):
        text = list(base)
        text[i * 5] = f"edit{i}"
        rows.append((i, " ".join(text)))
    found = minhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["class_id"] for r in found} == {0}


def test_samples_agree_as_often_as_weighted_sets():
    draw = np.random.default_rng(8)
    a = np.sort(draw.integers(1, 1 << 62, 300).astype(np.uint64))
    agreed, expected = 0, 0.0
    for _ in range(60):
        w = draw.uniform(0.3, 3, 300)
        v = np.where(draw.random(300) < 0.2, w * 2, w)
        agreed += (minhash.samples(a, w) == minhash.samples(a, v)).mean()
        expected += minhash.weighted_jaccard((a, w), (a, v))
    assert agreed / 60 == pytest.approx(expected / 60, abs=0.05)


# --- urls -----------------------------------------------------------------


def test_urls_are_cut_and_ruled(spark):
    rules = [urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/")]
    cases = {
        "http://A.Example.COM/en/x?q#f": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "x://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, None),
        "http://b.org?x://y/z": ("b.org", "", None, None),
        "no scheme": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
        "http://h.org/" + "p" * 20000 + "#": ("h.org", "/" + "p" * 20000, None, None),
    }
    table = spark.sql("SELECT * FROM VALUES ('http://bad-casino.org/', 1), ('http://casino.net/x', 1), ('http://garden.org/', 0), ('http://news.net/x', 0) AS t(url, blocked)")
    model = urls.fit(table)
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string").withColumn("host", F.lit(1))
    found = {r["url"]: r for r in urls.judge(df, rules, model).collect()}
    for url, (host, path, rule, verdict) in cases.items():
        r = found[url]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["blocked_score"] >= 0.5 else "allow"))
    new = spark.createDataFrame([("http://my-casino.org/",), ("http://mygarden.net/x",)], "url string")
    assert [r["verdict"] for r in urls.judge(new, rules, model).orderBy("url").collect()] == ["block", "allow"]
    assert "Python" not in urls.judge(df, rules, model)._jdf.queryExecution().executedPlan().toString()
    assert urls.judge(df.where("false"), rules, model).count() == 0


# --- toxicity -------------------------------------------------------------


def test_maximal_segments_by_definition():
    draw = np.random.default_rng(9)

    def slow(scores, offset=0):
        best = max(
            ((sum(scores[i:j]), i - j, -i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
            default=(0, 0, 0, 0),
        )
        if best[0] <= 0:
            return []
        i, j = -best[2], best[3]
        return slow(scores[:i], offset) + [(offset + i, offset + j)] + slow(scores[j:], offset + j)

    for _ in range(60):
        scores = [float(x) for x in draw.choice([-3.25, -1.5, 1.125, 2.75, 4.0625], 14)]
        assert [x[:2] for x in toxicity.maximal_segments(scores)] == slow(scores)
    assert toxicity.maximal_segments([]) == []


def test_toxic_texts_are_found_by_held_out_words(spark):
    rows, labels = [], []
    for i in range(240):
        text = words(80, i, 300)
        if i % 6 == 0:
            for k in range(4):
                text[10 + 7 * k] = ("vile", "nasty", "foul", "rotten")[(i + k) % 4] + ("," if k else "")
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 6 == 0)))
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash"))
    marked = spark.createDataFrame(labels + [(None, 1), (3, None), (5, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marked.where("doc_id % 3 = 0"))
    more = docs.unionByName(spark.createDataFrame([(999, None, ""), (998, "", ""), (None, "vile nasty foul rotten", "")], docs.schema))
    found = toxicity.score(more, model).collect()
    assert len(found) == len(rows) + 3
    by_id = {r["doc_id"]: r for r in found}
    wrong = sum((by_id[i]["score"] >= 0.7) != bool(t) for i, t in labels)
    assert wrong <= 2 and by_id[999]["score"] == by_id[998]["score"] < 0.5 <= by_id[None]["score"]
    assert by_id[6]["passages"] and not by_id[1]["passages"]


def test_toxicity_scores_follow_the_true_share_of_labels(spark, monkeypatch):
    rows, labels = [], []
    for i in range(1500):
        text = words(60, i, 300)
        if i % 10 == 0 and i % 50 or i % 37 == 1:
            text[20:22] = ["vile", "foul"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 10 == 0)))
    docs = spark.createDataFrame(rows, DOCS)
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "MOST_LABELLED", 150)
    found = [r["score"] for r in toxicity.score(docs, toxicity.fit(docs, marked)).collect()]
    assert max(found) > 0.5 and sum(found) / len(found) == pytest.approx(0.1, abs=0.03)


def test_toxicity_without_labels_or_one_class(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], DOCS)
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["score"] < 0.01 for r in toxicity.score(docs, none).collect())
    clean = toxicity.fit(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert all(r["score"] < 0.01 for r in toxicity.score(docs, clean).collect())
    assert toxicity.score(docs.where("false"), none).count() == 0


# --- repeated passages ----------------------------------------------------


def slow_removal(rows):
    first = {}
    for doc, text in rows:
        w = (text or "").split()
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = (text or "").split()
        gone = {i + o for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < doc for o in range(13)}
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_repeated_passages_equal_brute_force(spark):
    passage, few = words(30, 50), words(13, 51)
    rows = [(i, " ".join(words(40 + i, i, 30 if i % 3 else 400) + (passage if i % 2 else few) + words(9, 100 + i))) for i in range(24)]
    rows += [(30, " ".join(passage[:12])), (31, " ".join(passage[3:17])), (32, rows[4][1]), (33, None), (34, "")]
    rows += [(40, "same " * 60), (41, "same " * 14), (41, "same " * 14), (41, "another text"), (42, " ".join(passage + passage))]
    found = substrings.without_repeats(spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit(0)))
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect())
    assert got == sorted(slow_removal(rows))
    alone = substrings.without_repeats(spark.createDataFrame([(None, " ".join(passage)), (1, " ".join(passage))], DOCS))
    assert [r["n_removed"] for r in alone.collect()] == [0, 0]
    assert substrings.without_repeats(found.where("false").select("doc_id", "text")).count() == 0


def test_blocks_cover_every_window_once():
    h = np.random.default_rng(4).integers(0, 1 << 62, 500).astype(np.uint64)
    _, _, starts, counts = substrings.blocks(h)
    assert starts[0] == 0 and (starts[1:] == (starts + counts)[:-1]).all() and starts[-1] + counts[-1] == 500 - 12
    assert counts.max() <= 10 and len(substrings.blocks(h[:12])[0]) == 0


def test_folds_are_crc32(spark):
    from siftframe.llm.common import remainder

    rows = spark.range(50).select("id", remainder(F.col("id"), 7).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in rows)
