"""Tokenizers, filters, chains, stems and mappings."""

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from siftframe import Collection, Field, Mapping
from siftframe.functions import analysis as a
from siftframe.functions import grams as g
from siftframe.functions.stemming import porter
from siftframe.plans import conditions as q
from siftframe.sources import documents as d
from siftframe.sources import mapping as mp


@pytest.fixture(scope="module")
def run(spark):
    def tokens(stage, text):
        value = text if isinstance(text, list) else [text]
        kind = "array<string>" if isinstance(text, list) else "string"
        df = spark.createDataFrame([(text,) if isinstance(text, list) else (value[0],)], f"x {kind}")
        return df.select(stage(F.col("x")).alias("t")).head().t

    return tokens


@pytest.mark.parametrize(
    "stage, text, expected",
    [
        (a.standard, "Café au lait, 2nd_time!", ["Café", "au", "lait", "2nd_time"]),
        (a.standard, "中文abc字", ["中", "文", "abc", "字"]),
        (a.standard, None, None),
        (a.standard, "", []),
        (a.standard_limited(3), "abcdefg hi", ["abc", "def", "g", "hi"]),
        (a.letter, "it's 2 o'clock", ["it", "s", "o", "clock"]),
        (a.lowercase_letter, "Ab-Cd", ["ab", "cd"]),
        (a.whitespace, " a,b  c\n", ["a,b", "c"]),
        (a.keyword, "a b", ["a b"]),
        (a.pattern(","), "a,,b", ["a", "b"]),
        (a.ngram(), "abc", ["a", "b", "c", "ab", "bc"]),
        (a.ngram(2, 5), "a", []),
        (a.edge_ngram(2, 4), "abc", ["ab", "abc"]),
        (a.edge_ngram(2, 4), "a", []),
        (a.path_hierarchy, "/foo/bar/baz", ["/foo", "/foo/bar", "/foo/bar/baz"]),
        (a.path_hierarchy, "foo/bar", ["foo", "foo/bar"]),
        (a.path_hierarchy, "", []),
        (a.url_email, "see https://a.b/c?d=1 or me.x@y.org now", ["see", "https://a.b/c?d=1", "or", "me.x@y.org", "now"]),
        (a.tokenizer("whitespace", max_token_length=2), "abcde f", ["ab", "cd", "e", "f"]),
        (a.tokenizer("ngram", min_gram=2, max_gram=2, token_chars=("letter",)), "ab1cde", ["ab", "cd", "de"]),
        (a.html_strip, "<p>Hello</p>", "Hello"),
        (a.html_strip, "<style>p{}</style>a<!-- x -->&lt;b&gt; &amp;lt;<SCRIPT>1<2</script>", "a <b> &lt;"),
        (a.char_mapping({"&": "and"}), "a & b", "a and b"),
        (a.pattern_replace(r"(\d+)-(\d+)", "$1_$2"), "1-2", "1_2"),
    ],
)
def test_stages_on_text(run, stage, text, expected):
    assert run(stage, text) == expected


@pytest.mark.parametrize(
    "stage, tokens, expected",
    [
        (a.stop(), ["the", "cat", "is", "the", "best"], ["cat", "best"]),
        (a.stop(["cat"]), ["the", "cat"], ["the"]),
        (a.uppercase, ["ab"], ["AB"]),
        (a.synonym({"quick": ["fast", "rapid"]}), ["quick", "fox"], ["quick", "fast", "rapid", "fox"]),
        (a.unique, ["b", "a", "b"], ["b", "a"]),
        (a.truncate(2), ["abc", "d"], ["ab", "d"]),
        (a.limit(2), ["a", "b", "c"], ["a", "b"]),
        (a.reverse, ["hello"], ["olleh"]),
        (a.length(2, 3), ["a", "ab", "abcd"], ["ab"]),
        (a.token_ngram(1, 2), ["ab", "c"], ["a", "b", "ab", "c"]),
        (a.token_edge_ngram(1, 2), ["abc", "d"], ["a", "ab", "d"]),
        (a.asciifolding, ["café", "Straße", "Łódź", "ĳ"], ["cafe", "Strasse", "Lodz", "ĳ"]),
        (a.trim, ["  x "], ["x"]),
        (a.word_delimiter, ["WiFi", "PowerShot500", "HTTPServer", "a-b"], ["Wi", "Fi", "Power", "Shot", "500", "HTTPServer", "a", "b"]),
        (a.porter_stem, ["running", "flies", "relational"], ["run", "fli", "relat"]),
    ],
)
def test_filters_on_tokens(run, stage, tokens, expected):
    assert run(stage, tokens) == expected


def grams_of(words, lo, hi):
    return [w[i : i + n] for w in words for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("part, cut", [(1, 1), (60, 20), (g.PART, g.CUT)])
@pytest.mark.parametrize("lo, hi", [(1, 2), (2, 3), (0, 1), (3, 9)])
def test_grams_of_many_words(monkeypatch, part, cut, lo, hi):
    monkeypatch.setattr(g, "PART", part)
    monkeypatch.setattr(g, "CUT", cut)
    rows = [["abc", "é😀中x", "a", ""], None, [], ["ab", None], ["\0|", "abcdefghijk" * 3]] * 3
    lists = pa.array(rows, pa.list_(pa.string())).slice(1)
    parts = [p.to_pylist() for p in g.gram_lists(lists, lo, hi)]
    assert [x for p in parts for x in p] == [None if r is None or None in r else grams_of(r, lo, hi) for r in rows[1:]]
    assert len(parts) > 1 or part == g.PART


def test_grams_of_tokens_are_cut_in_bulk(spark):
    rows = [(["Café", "中文x", "a"],), (["ab", None],), ([],), (None,)]
    df = spark.createDataFrame(rows, "x array<string>")
    bulk = df.select(a.token_ngram(2, 3)("x").alias("t"))
    assert "transform(" not in bulk._jdf.queryExecution().optimizedPlan().toString()
    expected = [["Ca", "af", "fé", "Caf", "afé", "中文", "文x", "中文x"], None, [], None]
    assert [r.t for r in bulk.collect()] == expected
    assert [r.t for r in df.select(a.token_ngram(2, 3).inside(F.col("x")).alias("t")).collect()] == expected


def test_gram_chain_on_lists_and_inside_objects(spark):
    chain = a.analyzer("standard", (a.token_ngram(2, 2),))
    schema = "_id string, names array<string>, parts array<struct<name: string>>"
    df = spark.createDataFrame([("1", ["abc", "de"], [("xyz",), ("uv",)]), ("2", ["cd"], [])], schema)
    inner = Field("nested", properties={"name": Field("text", analyzer=chain)})
    c = Collection(df, Mapping({"names": Field("text", analyzer=chain), "parts": inner}))
    assert [r.t for r in df.select(c.scope.slot("names").tokens().alias("t")).collect()] == [["ab", "bc", "de"], ["cd"]]
    found = q.nested("parts", q.match("name", "yz"))
    assert [r._id for r in df.where(found.truth(c.scope)).collect()] == ["1"]


def test_words_are_the_same_characters_as_ever(spark):
    chars = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343")
    chars = chars.select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    ever = F.regexp_extract_all("c", F.lit(r"\p{IsHan}|[\p{L}\p{M}\p{N}_&&[^\p{IsHan}]]+"), F.lit(0))
    # Beside a letter a character shows whether it ends a word.
    beside = chars.withColumn("c", F.concat(F.lit("x"), "c", F.lit("y")))
    assert chars.where(a.standard(F.col("c")) != ever).count() == 0
    assert beside.where(a.standard(F.col("c")) != ever).count() == 0


# Examples printed in the paper.
STEMS = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss
fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc
digitizer digit conformabli conform radicalli radic differentli differ vileli vile analogousli analog operator oper
feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens
irritant irrit replacement replac adjustment adjust dependent depend adoption adopt communism commun activate activ
effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll""".split()


def test_porter_examples():
    assert {w: porter(w) for w in STEMS[::2]} == dict(zip(STEMS[::2], STEMS[1::2]))
    assert porter("café") == "café" and porter("be") == "be"


def test_named_and_custom_chains(run):
    chain = a.analyzer("standard", ("lowercase", "stop", "porter_stem"), ("html_strip",))
    assert run(chain.tokens, "<b>The runners</b> are running") == ["runner", "run"]
    assert run(a.named_analyzer("french").tokens, "Le chat et la souris") == ["chat", "souris"]
    assert run(a.named_analyzer("simple").tokens, "A1 b") == ["a", "b"]
    with pytest.raises(ValueError):
        a.named_analyzer("nope")


@pytest.mark.parametrize("small", [True, False])
def test_rules_table(spark, monkeypatch, small):
    monkeypatch.setattr(a, "fits_broadcast", lambda df, max_rows: small)
    df = spark.createDataFrame([("1", ["better", "is", "better"]), ("2", []), ("3", None)], "_id string, w array<string>")
    rules = spark.createDataFrame([("better", "good"), ("better", "well"), ("was", "be")], "word string, form string")
    lemma = {r["_id"]: r.out for r in a.expand_tokens(df, "_id", "w", rules, keep=False, out="out").collect()}
    assert lemma == {"1": ["good", "well", "is", "good", "well"], "2": [], "3": None}
    both = {r["_id"]: r.out for r in a.expand_tokens(df, "_id", "w", rules, keep=True, out="out").collect()}
    assert both["1"] == ["better", "good", "well", "is", "better", "good", "well"]


def test_stemmed_field_matches_stemmed_query(spark):
    chain = a.analyzer("standard", ("lowercase", "porter_stem"))
    df = spark.createDataFrame([("1", "He runs"), ("2", "a runner")], "_id string, t string")
    c = Collection(df, Mapping({"t": Field("text", analyzer=chain)}))
    assert [r["_id"] for r in q.where(c.df, q.match("t", "running"), c.scope).collect()] == ["1"]


def test_apply_mapping_types_and_bad_values(spark):
    declared = Mapping(
        {
            "b": Field("byte"), "l": Field("long"), "f": Field("half_float"), "s": Field("scaled_float", scaling_factor=100),
            "u": Field("unsigned_long"), "d": Field("date", formats=("yyyy-MM-dd", "epoch_millis")), "ok": Field("boolean"),
            "bin": Field("binary"), "r": Field("integer_range"), "p": Field("geo_point"), "m": Field("flattened"),
            "o": Field("object", properties={"x": Field("integer"), "y": Field("object", properties={"z": Field("keyword")})}),
            "n": Field("nested", properties={"k": Field("keyword")}), "v": Field("dense_vector"),
            "t": Field("text", fields={"keyword": Field("keyword", ignore_above=3), "length": Field("token_count")}),
            "same": Field("alias", path="l"), "absent": Field("double"),
        }
    )
    names = ["b", "l", "f", "s", "u", "d", "ok", "bin", "r", "p", "m", "o", "n", "v", "t"]
    good = ["7", "8", "1.5", "2.34", "18446744073709551615", "2024-02-03", "true", "aGk=", '{"gte":1,"lte":5}',
            '{"lat":1.5,"lon":2.5}', '{"a":"1"}', '{"x":1,"y":{"z":"q"}}', '[{"k":"a"}]', "[1.0,2.0]", "one two"]
    bad = ["300", "x", "y", "z", "-", "0", "maybe", "%", "]", "]", "]", "]", "]", "]", "abc"]
    df = spark.createDataFrame([good, bad], names)
    seen = Observation()
    out = mp.apply_mapping(df, declared, observation=seen)
    first, second = out.collect()
    assert (first.b, first.l, first.f, str(first.s), int(first.u)) == (7, 8, 1.5, "2.34", 2**64 - 1)
    assert first.d == dt.datetime(2024, 2, 3) and first.ok is True and bytes(first.bin) == b"hi"
    assert first.r.lte == 5 and first.p.lon == 2.5 and first.m == {"a": "1"} and first.o.y.z == "q"
    assert first.n[0].k == "a" and first.v == [1.0, 2.0] and first.same == 8 and first.absent is None
    assert (first.t__keyword, first.t__length, second.t__keyword) == (None, 2, "abc")
    assert second.d == dt.datetime(1970, 1, 1)
    assert second["_ignored"] == ["b", "l", "f", "s", "u", "ok", "bin", "r", "p", "m", "o", "n", "v"] or set(
        second["_ignored"]
    ) >= {"b", "l", "f", "s", "u", "ok", "bin"}
    assert first["_ignored"] == [] and seen.get["b"] == 1 and seen.get["d"] == 0


def test_extend_mapping(spark):
    df = spark.createDataFrame([("1",)], "_id string")
    wider, mapping = mp.extend_mapping(df, Mapping({"_id": Field("keyword")}), {"n": Field("integer")})
    assert wider.schema["n"].dataType.simpleString() == "int" and mapping.fields["n"].type == "integer"
    with pytest.raises(ValueError):
        mp.extend_mapping(wider, mapping, {"n": Field("text")})
    with pytest.raises(ValueError):
        Field("nonsense")


def test_multi_field_alias_and_flattened(spark):
    declared = Mapping(
        {
            "title": Field("text", fields={"keyword": Field("keyword", ignore_above=8)}),
            "name": Field("alias", path="title"),
            "props": Field("flattened"),
        }
    )
    df = spark.createDataFrame([("1", "Red Fox", {"k": "7"}), ("2", "A very red fox", {})], "_id string, title string, props map<string,string>")
    c = Collection(mp.with_multi_fields(df, declared), declared)
    hits = lambda cond: [r["_id"] for r in q.where(c.df, cond, c.scope).orderBy("_id").collect()]
    assert hits(q.match("name", "fox")) == ["1", "2"]
    assert hits(q.term("title.keyword", "Red Fox")) == ["1"]
    assert hits(~q.exists("title.keyword")) == ["2"]
    assert hits(q.term("props.k", "7")) == ["1"]
    assert hits(~q.exists("props.k")) == ["2"]


def test_alias_view_and_documents(spark):
    df = spark.createDataFrame([("1", "active"), ("2", "gone")], "_id string, status string")
    d.alias_view(Collection(df), "live", q.term("status", "active"))
    assert [r["_id"] for r in spark.table("live").collect()] == ["1"]
    children = spark.createDataFrame([("1", 2, "b"), ("1", 1, "a")], "_id string, pos int, t string")
    rows = {r["_id"]: r.items for r in d.gather_objects(df, children, "_id", "items", "pos").collect()}
    assert [x.t for x in rows["1"]] == ["a", "b"] and rows["2"] == []
    parsed = d.parse_documents(spark.createDataFrame([('{"a":1}',)], "j string"), "j", "a int").head()
    assert parsed.a == 1
    built = df.select(d.document(id=F.col("_id"), all=d.list_of(F.col("_id"), F.col("status"))).alias("doc")).head()
    assert built.doc.all == ["1", "active"]


PHRASE_ROWS = [
    ("1", ["i", "love", "new", "york", "city", "in", "new", "york"]),
    ("2", ["new", "new", "york"]),
    ("3", []),
    ("4", None),
    ("5", ["york", "new"]),
    ("6", ["a", "b", "c", "d"]),
    ("7", ["big", None, "apple", "big", "apple"]),
]
PHRASE_RULES = [
    ("new york", "ny"), ("new york city", "nyc"), ("york", "yk"), ("a b", "x y"), ("b c d", "z"), ("big apple", "ny"),
    ("big apple", "nyc"), (None, "n"), ("city", None), ("c", "cc"),
]


def rewritten(tokens, keep):
    """Rules applied one place after the other."""
    rules = {}
    for phrase, form in PHRASE_RULES:
        if phrase and form:
            rules.setdefault(tuple(phrase.split(" ")), []).append(form)
    if tokens is None:
        return None
    out, i = [], 0
    while i < len(tokens):
        for n in (3, 2, 1):
            words = tuple(tokens[i : i + n])
            if len(words) == n and words in rules:
                out += (list(words) if keep else []) + " ".join(sorted(rules[words])).split(" ")
                i += n
                break
        else:
            out.append(tokens[i])
            i += 1
    return out


@pytest.mark.parametrize("keep", [False, True])
@pytest.mark.parametrize("inline", [50_000, 0])
def test_rules_of_several_words(spark, monkeypatch, keep, inline):
    monkeypatch.setattr(a, "INLINE_RULES", inline)
    df = spark.createDataFrame([(*r, "old") for r in PHRASE_ROWS], "_id string, w array<string>, out string")
    rules = spark.createDataFrame(PHRASE_RULES, "phrase string, form string")
    found = a.expand_phrases(df, "w", rules, keep=keep, out="out")
    assert {r["_id"]: r["out"] for r in found.collect()} == {i: rewritten(w, keep) for i, w in PHRASE_ROWS}
    none = a.expand_phrases(df, "w", rules.where("false"), keep=keep, out="out")
    assert {r["_id"]: r["out"] for r in none.collect()} == dict(PHRASE_ROWS)
    assert a.expand_phrases(df.where("false"), "w", rules, keep=keep, out="out").count() == 0


def test_small_rules_move_nothing(spark, monkeypatch):
    df = spark.createDataFrame([("1", ["x", "y", None]), ("2", None)], "_id string, w array<string>")
    rules = spark.createDataFrame([("x", "xx"), ("x", "xy"), ("z", "zz")], "word string, form string")
    found = a.expand_tokens(df, "_id", "w", rules, keep=True, out="out")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    small = {r["_id"]: r["out"] for r in found.collect()}
    monkeypatch.setattr(a, "INLINE_RULES", 0)
    assert small == {r["_id"]: r["out"] for r in a.expand_tokens(df, "_id", "w", rules, keep=True, out="out").collect()}
    assert small == {"1": ["x", "xx", "xy", "y", None], "2": None}


def test_stems_by_vocabulary_equal_stems_by_row(spark):
    rows = [("1", ["running", "flies", "running", None, "sky"]), ("2", None), ("3", []), ("4", ["relational", "ponies"])]
    df = spark.createDataFrame([(*r, "old") for r in rows], "_id string, w array<string>, out string")
    found = {r["_id"]: r["out"] for r in a.stem_tokens(df, "w", "out").collect()}
    assert found == {i: w and [x and porter(x) for x in w] for i, w in rows}
    assert found["4"] == ["relat", "poni"]
    assert a.stem_tokens(df.where("false"), "w", "out").count() == 0


def test_a_large_dictionary_moves_a_rows_words_once_and_without_places(spark, monkeypatch):
    from pyspark.sql import functions as F

    from siftframe.functions import analysis as an

    monkeypatch.setattr(an, "INLINE_RULES", 0)
    many = [f"w{i % 700}" for i in range(3000)]
    rows = [(1, many), (1, ["x", "w1", None, "w1"]), (2, []), (3, None), (4, ["x"]), (5, [None])]
    df = spark.createDataFrame(rows, "i int, t array<string>")
    rules = spark.createDataFrame([(f"w{i}", f"f{i}") for i in range(600)] + [("w1", "e1"), (None, "n"), ("x", None)], "word string, form string")
    forms = {f"w{i}": [f"f{i}"] for i in range(600)} | {"w1": ["e1", "f1"], "x": []}
    moved = []
    explode = F.explode_outer
    monkeypatch.setattr(F, "posexplode_outer", lambda c: moved.append("places"))
    monkeypatch.setattr(F, "explode_outer", lambda c: moved.append("words") or explode(c))
    for keep in (False, True):
        found = an.expand_tokens(df, "i", "t", rules, keep=keep, out="t2")
        new = lambda w: ([w] if keep else []) + forms[w] if w in forms else [w]  # noqa: B023, E731
        want = [(i, t and [f for w in t for f in new(w)] if t else t) for i, t in rows]
        assert found.columns == ["i", "t", "t2"]
        assert sorted((r["i"], str(r["t2"])) for r in found.collect()) == sorted((i, str(t)) for i, t in want)
    assert moved == ["words", "words"]
