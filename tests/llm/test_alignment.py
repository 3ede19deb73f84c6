from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from conftest import DATA
from silverlode.llm import alignment
from silverlode.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
tool, model = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
tool.encode_special_tokens = True
# The printable form of bytes in byte-level vocabularies, as a rule.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in PRINTED} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in PRINTED)}


def b_bytes(k):
    piece = model.id_to_piece(k)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode()


def plain(text):
    """Groups of (A ids, B ids), by sets of offsets."""
    if not text:
        return []
    a, b = tool.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    spelt_a, spelt_b = [bytes(BYTE[c] for c in tool.id_to_token(k)) for k in a], [b_bytes(k) for k in b]
    if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in spelt_a]).tolist(), np.cumsum([len(x) for x in spelt_b]).tolist()
    found, start = [], 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        found.append(([k for k, e in zip(a, ends_a) if start < e <= cut], [k for k, e in zip(b, ends_b) if start < e <= cut]))
        start = cut
    return found


def fast_plain(text):
    """The same for longer texts, one merge over both lists."""
    if not text:
        return []
    a, b = tool.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    spelt_a, spelt_b = [bytes(BYTE[c] for c in tool.id_to_token(k)) for k in a], [b_bytes(k) for k in b]
    if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
        return []
    found, x, y, i, j = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            found[-1][0].append(a[i])
            x, i = x + len(spelt_a[i]), i + 1
        else:
            found[-1][1].append(b[j])
            y, j = y + len(spelt_b[j]), j + 1
        if x == y:
            found.append(([], []))
    return found[:-1]


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def figures(rows, groups_of=plain):
    """Expected rows for (doc_id, text) rows."""
    groups = [groups_of(t) for _, t in rows]
    links = [Counter((a, b) for p, q in g for a in p for b in q) for g in groups]
    count = Counter(pair for own in links for pair in own)
    most: dict = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    return [
        (
            k,
            sum(len(p) for p, _ in g),
            sum(len(q) for _, q in g),
            len(g),
            sum(own.values()),
            sum(n for (a, b), n in own.items() if count[a, b] == most[a]),
            sum(n * count[pair] for pair, n in own.items()),
            hashlib.sha256(shown(g).encode()).hexdigest() if g else "",
        )
        for (k, _), g, own in zip(rows, groups, links)
    ]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
CASES = [
    "Hello, world.", "", None, "  two  spaces \n\n new\tline ", "Hello, world.", "日本語のテキスト", "a▁b c", "naïve \U0001f600 x" * 3,
    "<s> </s> <|endoftext|> <unk> <0x41>", "x" * 500, " ", "\n", "  odd  spaces", "é ﬁ ２", "it's they'll 12345 3.14", "\r\n \x00 z", "▁", "ends in space ",
]


def test_cases(spark):
    rows = list(enumerate(CASES)) + [(3, "other words"), (None, "no id"), (3, "other words")]
    docs = spark.createDataFrame([(k, t, "n", 0, "b") for k, t in rows], "doc_id bigint, text string, key string, n_a int, batch string")
    got = [tuple(r[c] for c in NAMES) for r in alignment.agreement(docs, A, B).collect()]
    assert ordered(got) == ordered(figures(rows))


def test_groups(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id bigint, text string")
    for r in alignment.groups(docs, A, B).collect():
        a, b = iter(r.a_ids), iter(r.b_ids)
        found = [([next(a) for _ in range(p)], [next(b) for _ in range(q)]) for p, q in zip(r.a_sizes, r.b_sizes)]
        want = plain(CASES[r.doc_id])
        assert found == want
        assert r.cuts == np.cumsum([sum(len(b_bytes(k)) for k in q) for _, q in want]).tolist()


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.agreement(docs, A, B).collect() == [] and alignment.groups(docs, A, B).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id bigint, text string")
    assert {tuple(r[c] for c in NAMES) for r in alignment.agreement(nothing, A, B).collect()} == {(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)}


def test_long_texts(spark):
    base = spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet")).where("text IS NOT NULL").select("text").limit(40).collect()
    long = "\n".join(r.text for r in base) * 12
    rows = [(1, long), (2, "x" * 30_000), (3, "ab " * 20_000), (4, "日" * 9_000), (5, long)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r[c] for c in NAMES) for r in alignment.agreement(docs, A, B).collect()]
    assert ordered(got) == ordered(figures(rows, fast_plain))


def test_query_on_a_whole_table(spark):
    folder = str(DATA / "sf0.001")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    result = QUERIES["op11_lockstep_alignment"](spark, folder)
    assert dict(result.dtypes) == {"doc_id": "bigint", "groups_sha256": "string"} | {c: "bigint" for c in NAMES[1:-1]}
    assert ordered([tuple(r[c] for c in NAMES) for r in result.collect()]) == ordered(figures(rows, fast_plain))


def test_repeated_pair_over_many_batches(spark):
    rows = [(k, "the same words") for k in range(3000)] + [(5000 + k, f"word{k} the") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = [tuple(r[c] for c in NAMES) for r in alignment.agreement(docs, A, B).collect()]
    assert ordered(got) == ordered(figures(rows))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab c.\n\té日▁<s>0'é😀 "), max_size=30), max_size=6))
def test_any_texts(texts):
    encoded = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    found = alignment.Alignment(data, np.concatenate(([0], np.cumsum([len(e) for e in encoded]))).astype(np.int64), A, B)
    assert [t.decode() for t in found.spelt_groups()] == [shown(plain(t)) for t in texts]


def test_known_stretches_are_looked_up_in_place(monkeypatch):
    texts = ["the cat sat " * 200, "", "a dog, the cat", "x" * 3000 + " y"]
    encoded = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(encoded), np.uint8), np.concatenate(([0], np.cumsum([len(e) for e in encoded]))).astype(np.int64)
    rng = np.random.default_rng(1)
    for size in (0, 1, 50):
        ordered, values = np.unique(rng.integers(0, 99, size)), rng.integers(0, 120, 40)
        assert alignment._holds(ordered, values).tolist() == np.isin(values, ordered).tolist()

    def whole(*_):
        raise AssertionError("goes over the whole memory for every batch")

    monkeypatch.setattr(np, "isin", whole)
    for _ in range(2):
        found = alignment.Alignment(data, offsets, A, B)
        assert [t.decode() for t in found.spelt_groups()] == [shown(plain(t)) for t in texts]
