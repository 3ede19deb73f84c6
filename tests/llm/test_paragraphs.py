from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from silverlode.llm import paragraphs
from test_order_minhash import plain_kmers


def brute(rows, least=0.8, fewest=50):
    table = []
    for k, (doc, text) in enumerate(rows):
        for place, line in enumerate((text or "").split("\n")):
            w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", line.lower())
            if w:
                table.append((doc, k, place, tuple(w), plain_kmers(line)))
    label = list(range(len(table)))

    def join(i, j):
        nonlocal label
        a, b = label[i], label[j]
        if a != b:
            label = [min(a, b) if x in (a, b) else x for x in label]

    for i in range(len(table)):
        for j in range(i):
            if table[i][3] == table[j][3]:
                join(i, j)
            elif min(len(table[i][3]), len(table[j][3])) >= 5:
                a, b = set(table[i][4]), set(table[j][4])
                if len(a & b) / len(a | b) >= least:
                    join(i, j)
    firsts = {}
    for i, t in enumerate(table):
        if label[i] not in firsts or (t[0], t[2]) < firsts[label[i]][:2]:
            firsts[label[i]] = (t[0], t[2], i)
    marked = {}
    for i, t in enumerate(table):
        if firsts[label[i]][2] != i:
            marked.setdefault(t[1], []).append(t[2])
    return [paragraphs.cut((text or "").encode(), marked.get(k, []), fewest)[0].decode() if text is not None else None for k, (_, text) in enumerate(rows)]


LOWER = {k: k + 32 for k in range(ord("A"), ord("Z") + 1)}


def brute_runs(rows, fewest=50):
    """Every window of words that comes before goes; where it overlaps its own first occurrence, that stays."""
    seen, out = {}, {}
    for k, (doc, text) in sorted(enumerate(rows), key=lambda r: r[1][0]):
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))
        spans = []
        for p in range(len(w) - fewest + 1):
            d, q = seen.setdefault(tuple(w[p : p + fewest]), (doc, p))
            if (d, q) != (doc, p):
                spans.append((max(p, q + fewest) if d == doc else p, p + fewest))
        out[k] = paragraphs.cut_runs(text.encode(), spans)[0].decode() if spans else text
    return [out[k] for k in range(len(rows))]


def brute_repeats(rows):
    """Both passes in turn, for rows with different ids."""
    left = brute(rows)
    return brute_runs([(k, t) for (k, _), t in zip(rows, left)])


@pytest.mark.parametrize("seed", [4, 5])
def test_both_passes_against_all_pairs_and_windows(spark, seed):
    rows = _rows(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in paragraphs.remove_repeats(docs).collect()}
    assert {k: r.text for k, r in got.items()} == {k: t for (k, _), t in zip(rows, brute_repeats(rows))}
    assert all(r.n_bytes_removed == len((dict(rows)[k] or "").encode()) - len((r.text or "").encode()) for k, r in got.items())


def _rows(seed):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices("abcdefé", k=pick.randint(2, 7))) for _ in range(400)]
    line = lambda n: " ".join(pick.choices(vocabulary, k=n)).capitalize() + "."
    passages = ["\n".join(line(pick.randint(8, 70)) for _ in range(pick.randint(1, 4))) for _ in range(8)]
    rows = []
    for k in range(60):
        parts = []
        for _ in range(pick.randint(1, 5)):
            if pick.random() < 0.4:
                p = pick.choice(passages).split(" ")
                if len(p) > 60 and pick.random() < 0.5:
                    p[len(p) // 2] = "zz"
                parts.append(" ".join(p))
            else:
                parts.append(line(pick.randint(3, 80)))
            if pick.random() < 0.2:
                parts.append("")
        rows.append((k, "\n".join(parts)))
    return [*rows, (98, None), (99, "")]


@pytest.mark.parametrize("seed", [0, 1])
def test_against_all_pairs(spark, seed):
    rows = _rows(seed)
    docs = spark.createDataFrame([(k, t, "s", 1) for k, t in rows], "doc_id bigint, text string, row string, marked int")
    got = {r.doc_id: r for r in paragraphs.remove_passages(docs).collect()}
    want = brute(rows)
    assert {k: got[k].text for k, _ in rows} == {k: t for (k, _), t in zip(rows, want)}
    assert sum(r.n_lines_removed for r in got.values()) > 10 and all(r.marked == 1 for r in got.values())


def test_nulls_and_repeated_rows(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(None, long), (None, long), (3, "start\n" + long + "\nend"), (4, None), (4, None)]
    got = paragraphs.remove_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [(0, long), (0, long), (3, "start\nend"), (4, ""), (4, "")]


def test_clashing_names(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long, 7, 8, 9, 70), (2, "start\n" + long, 7, 8, 9, 70)]
    names = "doc_id bigint, text string, n_lines_removed int, N_bytes_removed int, _before int, n_chars int"
    docs = spark.createDataFrame(rows, names)
    got = {r.doc_id: r for r in paragraphs.remove_repeats(docs).collect()}
    assert [tuple(got[k])[2:5] for k in (1, 2)] == [(7, 8, 9)] * 2
    assert (got[2].text, got[2]["n_lines_removed_"], got[2]["n_bytes_removed_"]) == ("start\n", 1, len(long))
    kept = paragraphs.without_passages(docs)
    assert kept.columns == docs.columns and {r.doc_id: r.n_chars for r in kept.collect()} == {1: 70, 2: 6}


def test_empty(spark):
    assert paragraphs.remove_passages(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_bands():
    assert paragraphs.bands(0.8) == 6 and 1 - (1 - 0.8**2) ** 6 >= 0.995


def test_passages_inside_lines_go(spark):
    pick = random.Random(5)
    word = lambda n: [f"w{pick.randrange(10**6)}" for _ in range(n)]
    shared, other, own = word(60), word(49), [word(40) for _ in range(8)]
    text = lambda *parts: " ".join(w for p in parts for w in p)
    rows = [
        (1, text(own[0], shared, own[1])),
        (2, text(own[2], shared, own[3]) + "\nend"),
        (3, text(own[4], shared[:30]).upper() + ",\n" + text(shared[30:], own[5])),  # laid out in other lines
        (4, text(own[6], other)),
        (5, text(other, own[7])),  # 49 words are too few
        (6, "v " * 300),
        (7, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in paragraphs.remove_repeats(docs).collect()}
    assert [got[k].text for k in (1, 4, 5, 7)] == [rows[k - 1][1] for k in (1, 4, 5, 7)]
    assert got[2].text == text(own[2], own[3]) + "\nend"
    assert got[3].text.split() == text(own[4]).upper().split() + own[5]
    assert got[6].text.split() == ["v"] * 50
    assert all(r.n_bytes_removed == len(rows[k - 1][1] or "") - len(r.text or "") for k, r in got.items())


@pytest.mark.parametrize("seed", [2, 3])
def test_runs_against_all_windows(spark, seed):
    pick = random.Random(seed)
    pool = [f"w{k}" for k in range(3000)]
    rows = []
    for k in range(30):
        w = []
        while len(w) < 200:
            s = pick.randrange(2900)
            w += pool[s : s + pick.randint(20, 100)]
        rows.append((k, " ".join(w)))
    seen, want = {}, {}
    for k, t in rows:
        w = t.split()
        gone = set()
        for p in range(len(w) - 49):
            d, q = seen.setdefault(tuple(w[p : p + 50]), (k, p))
            if (d, q) != (k, p):
                gone.update(range(max(p, q + 50) if d == k else p, p + 50))
        want[k] = [x for n, x in enumerate(w) if n not in gone]
    got = paragraphs.remove_runs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.text.split() for r in got} == want and sum(r.n_bytes_removed for r in got) > 500


def test_short_wrapped_lines_with_changes_go(spark):
    pick = random.Random(7)
    wrapped = [[f"w{pick.randrange(10**6)}" for _ in range(19)] for _ in range(4)]
    changed = [list(line) for line in wrapped]
    changed[1][-1], changed[2][0] = "x", "y"
    text = lambda lines: "\n".join(" ".join(line) for line in lines)
    rows = [(1, text(wrapped)), (2, "start here\n" + text(changed) + "\nand end")]
    got = {r.doc_id: r for r in paragraphs.remove_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "start here\nand end" and got[2].n_lines_removed == 4


def test_working_arrays_of_a_batch_stay_small():
    import tracemalloc

    class Rows:
        """A frame of texts that hands one batch to the function it is mapped by."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            texts = pa.array([" ".join(f"w{k * n % 991}" for k in range(900)) for n in range(1, 1000)])
            tracemalloc.start()
            for _ in run(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
                pass
            self.peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()

    rows = Rows()
    paragraphs._members(rows, 0.8, 5)
    assert rows.peak < 64 << 20
