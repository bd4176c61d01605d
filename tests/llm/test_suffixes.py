"""Repeated byte strings against brute force, and the docstring's edge cases."""

import numpy as np
import pytest

from siftframe.llm import suffixes

DOCS = "doc_id long, text string, kept string, spans int"


def brute(rows, length):
    """{(doc, text): (n_bytes, n_removed, n_spans, kept)} by comparing all strings."""
    texts = sorted({(r[0], r[1] or "") for r in rows if r[0] is not None})
    seen, out = set(), {}
    for doc, text in texts:  # rows of one key with other texts are tested apart
        data = text.encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(data[i : i + length])
        gone = gone[:-1]
        starts = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc, text] = (len(data), int(gone.sum()), starts, bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


def check(spark, rows, length, parts=3):
    table = spark.createDataFrame(rows, DOCS).repartition(parts)
    found = suffixes.without_repeats(table, length=length)
    assert found.columns == ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
    found = found.collect()
    assert len(found) == len(rows)
    expected = brute(rows, length)
    for r in found:
        text = (r["text"] or "").encode()
        mine = (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
        assert mine == expected.get((r["doc_id"], r["text"] or ""), (len(text), 0, 0, text))
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
    return found


def corpus(seed, n, letters, shared):
    draw = np.random.default_rng(seed)
    word = lambda k: "".join(draw.choice(list(letters), k))
    passages = [word(int(draw.integers(10, 90))) for _ in range(shared)]
    rows = []
    for i in range(n):
        parts = [word(int(draw.integers(0, 60))) + passages[int(draw.integers(0, shared))][int(draw.integers(0, 9)) :] for _ in range(int(draw.integers(0, 5)))]
        rows.append((i, "".join(parts), "x", 1))
    return rows


@pytest.mark.parametrize("length", [7, 24, 40])
def test_equal_to_brute_force(spark, length):
    rows = corpus(length, 120, "abcdefghij é", 6)
    rows += [(1000, None, "x", 1), (1001, "", "x", 1), (None, rows[3][1], "x", 1), (1002, rows[5][1], "x", 1), rows[7], rows[7]]
    rows += [(1003, "z" * 300, "x", 1), (1004, "z" * 90, "x", 1), (1005, "ab" * 200, "x", 1)]  # periods
    check(spark, rows, length)


def test_few_letters_and_parts_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 64)
    monkeypatch.setattr(suffixes, "SETTLE", 200)
    monkeypatch.setattr(suffixes, "TOGETHER", 16)
    check(spark, corpus(1, 60, "ab", 4), 16)


def test_crowded_grams_have_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SETTLE", 500)
    rows = corpus(2, 80, "abcdefgh", 3)
    one = check(spark, rows, 24)
    monkeypatch.setattr(suffixes, "CROWD", 1)
    two = check(spark, rows, 24)
    key = lambda r: r["doc_id"]
    assert sorted(one, key=key) == sorted(two, key=key) and sum(r["n_removed"] for r in one) > 0


def test_rows_of_one_key_and_an_empty_table(spark):
    text = "a passage that stands in both of the texts of this key"
    table = spark.createDataFrame([(1, text + "!", "", 0), (1, "? " + text, "", 0)], DOCS)
    found = suffixes.without_repeats(table, length=20).collect()
    assert sorted(r["n_removed"] for r in found) == [0, len(text)]
    assert suffixes.without_repeats(table.limit(0), length=20).count() == 0


def test_layers_are_induced_as_if_sorted():
    """Every layer's order and common prefixes equal those of sorted suffixes."""
    draw = np.random.default_rng(4)
    length, rows = 6, []
    for group in range(5):
        for _ in range(30):
            count = int(draw.integers(1, 5))
            left = int(draw.integers(count - 1, 6))
            rows.append((group, left, count, bytes(draw.choice(list(b"ab"), count - 1 + length).tolist())))
    group, left, count = (np.array([r[i] for r in rows]) for i in range(3))
    # Blocks begin ``left`` bytes before the anchor, which lies inside them.
    left = np.minimum(left, length - 1)
    found = suffixes.repeated_strings(group, left, count, [r[3] for r in rows], length)
    seen = set()
    for r, (g, _, n, around) in enumerate(rows):
        strings = [(g, int(left[r]) - i, around[i : i + length]) for i in range(n)]
        for g_, layer, string in strings:
            assert found[r, layer] == ((g_, layer, string) in seen)
        assert not np.delete(found[r], [s[1] for s in strings]).any()
        seen.update(strings)
