"""Clustering, fill-in-the-middle and BPE against plain versions, with every awkward case."""

from __future__ import annotations

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import __spark_entry__ as contract  # noqa: E402
import corpus  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from llm import bpe, centroids, fim, tokens  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SMALL = "/root/testdata/sf0.001"
PATH = tokens.word_bpe_path()
LIBRARY = Tokenizer.from_file(PATH)
KINDS = pytest.mark.parametrize("clashing", [False, True])


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --------------------------------------------------------------- clustering


def plain_lloyd(rows: list[tuple], k: int, rounds: int, scale: int, dim: int) -> Counter:
    """The same with Python's numbers and loops."""
    finite = lambda x: x is not None and abs(x) < float("inf")
    kept = [(i, [int(scale * x // 1) if abs(x) < 2.0**900 else int(x) * scale for x in v]) for i, v in rows if v is not None and len(v) == dim and all(map(finite, v))]
    first = sorted((sha(f"2:{'' if i is None else i}"), v) for i, v in kept)
    where = [v for _, v in first[:k]]

    def nearest(v: list[int]) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(where))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(where)):
            if members := [v for (_, v), o in zip(kept, own) if o == n]:
                where[n] = [sum(column) // len(members) for column in zip(*members)]
    last, most = [nearest(v) for _, v in kept], (1 << 63) - 1
    sums = Counter()
    for distance, n in last:
        sums[n] += min(distance, most)
    every = min(sum(sums.values()), most)
    return Counter((i, n, min(d, most), min(sums[n], most), every, sha(",".join(map(str, where[n])))) for (i, _), (d, n) in zip(kept, last))


def vectors(spark, rows: list[tuple], clashing: bool = False):
    extra = [(*r, 1, 2, "d", 3) for r in rows] if clashing else rows
    return spark.createDataFrame(extra, "vec_id long, embedding array<double>" + (", cluster int, block long, data string, shard int" if clashing else ""))


@KINDS
@pytest.mark.parametrize("width", [2, 3, 64])
def test_lloyd_with_awkward_rows(spark, clashing, width):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(200, 260)] + [rows[3], rows[3], (3, [0.5] * 6), (None, [0.1] * 6), (None, [0.25] * 6)]
    rows += [(900, None), (901, []), (902, [1.0] * 5), (903, [None] + [1.0] * 5), (904, [float("nan")] + [1.0] * 5), (905, [float("-inf")] + [1.0] * 5)]
    found = centroids.lloyd(vectors(spark, rows, clashing), k=7, rounds=3, dim=6, width=width)
    assert Counter(tuple(r) for r in found.collect()) == plain_lloyd(rows, 7, 3, 256, 6)


def test_lloyd_with_few_equal_and_no_vectors(spark):
    for rows in ([(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(i, [1.0, 2.0]) for i in range(50)]):
        found = centroids.lloyd(vectors(spark, rows), k=4, rounds=2, dim=2)
        assert Counter(tuple(r) for r in found.collect()) == plain_lloyd(rows, 4, 2, 256, 2)
    none = centroids.lloyd(vectors(spark, [(1, None)]), k=4, rounds=2, dim=2)
    assert none.count() == 0 and none.columns == found.columns


@pytest.mark.parametrize("size", [1e5, 1e12, 1e200, 1e307])
def test_lloyd_with_numbers_beyond_64_bits(spark, size):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-size, size), rng.uniform(-1, 1), rng.uniform(-size, size)]) for i in range(30)] + [(99, [0.1, 0.2, 0.3])]
    found = centroids.lloyd(vectors(spark, rows), k=3, rounds=2, dim=3, width=2)
    assert Counter(tuple(r) for r in found.collect()) == plain_lloyd(rows, 3, 2, 256, 3)


def test_lloyd_over_many_blocks(spark, monkeypatch):
    rows = [(i, [float(np.sin(i * j)) for j in range(1, 9)]) for i in range(9000)]
    found = centroids.lloyd(vectors(spark, rows).repartition(3), k=5, rounds=2, dim=8, width=3)
    assert Counter(tuple(r) for r in found.collect()) == plain_lloyd(rows, 5, 2, 256, 8)


# ------------------------------------------------------- fill in the middle

ALPHABET = st.text(st.sampled_from("ab <>PSMé日🙂\n\x00ß"), max_size=400)


@settings(max_examples=60, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=8))
def test_index_gives_every_offset(texts):
    whole = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(whole), np.uint8)
    starts = np.cumsum([0, *map(len, whole)])
    index = fim.RankIndex(data, starts)
    assert np.diff(index.ranks).tolist() == [len(t) for t in texts]
    every = "".join(texts)
    assert index.offsets(np.arange(len(every) + 1)).tolist() == np.cumsum([0] + [len(c.encode()) for c in every]).tolist()


@pytest.mark.parametrize("text", ["a" * 5000, "é" * 5000, "a" * 3000 + "日" * 3000 + "a" * 3000 + "🙂" * 900, "a日" * 4000, ""])
def test_segments_are_few_and_within_the_bound(text, monkeypatch):
    monkeypatch.setattr(fim, "PIECE", 1 << 12)
    data = np.frombuffer(text.encode(), np.uint8)
    index = fim.RankIndex(data, np.array([0, len(data)]))
    assert index.offsets(np.arange(len(text) + 1)).tolist() == np.cumsum([0] + [len(c.encode()) for c in text]).tolist()
    assert len(index.first) <= 6 + len(data) // 4096 and np.abs(index.residuals.astype(int)).max() <= fim.BOUND + 1


def plain_fim(doc_id: int | None, text: str | None) -> tuple:
    text, digest = text or "", sha(f"1:{'' if doc_id is None else doc_id}")
    n, h = len(text), [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@KINDS
def test_fill_in_middle(spark, clashing):
    rng = random.Random(8)
    mixed = ["".join(rng.choice("ab<>PSM é日🙂\n") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    data = corpus.rows() + [(1000 + i, t, None, None, None) for i, t in enumerate([*mixed, "x<P>y", "<S>", "z<M>", "日本" * 60000, "<" * 9, "<M<S"])]
    made = fim.fill_in_middle(corpus.frame(spark, clashing, data))
    found = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restored(F.col("output"), F.col("form")), "text", "lang").collect()
    expected = [plain_fim(r[0], r[1]) for r in data]
    assert Counter(tuple(r)[:6] for r in found) == Counter(expected)
    assert all(r[6] == (r["text"] or "") for r in found)
    assert Counter((r["doc_id"], r["text"], r["lang"]) for r in found) == Counter(r[:3] for r in data)
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(corpus.frame(spark, clashing, data).limit(0)).count() == 0


def test_fill_in_middle_of_bytes_that_are_not_utf8(spark):
    data = spark.range(200).selectExpr("id AS doc_id", "CAST(unhex(concat('80BF41E9', hex(CAST(id AS STRING)), '8041')) AS STRING) AS text")
    made = fim.fill_in_middle(data).select(F.col("text").cast("binary"), fim.restored(F.col("output"), F.col("form")).cast("binary"), "form").collect()
    assert all(a == b for a, b, _ in made) and {r["form"] for r in made} == {"plain", "psm", "spm"}


# ---------------------------------------------------------------------- BPE

TEXTS = [
    "", "   ", "It's we'll DON'T İstanbul Σίσυφος ǅ ﬁ ſ Ꭰ", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> <|endoftext|", "12 345 ½ x2 日本語 🙂👍🏽 foo_bar a</w>b </w>",
    "é ́e ạ̇ ṩ \u0085x y​z　w", "a" * 4001, "ab" * 3000, "x." * 900, "!?" * 777 + "é" * 501, "\x00\x01 \x1c\x1dq", "aaa aaaa aaaaa hahahahaha",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_text_equal_the_library(text):
    codec, expected = bpe.codec(PATH), LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(codec.ids(text.encode()), "<i4").tolist() == expected
    assert codec.text(expected) == LIBRARY.decode(expected, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abcehinorst'., ", max_size=80), st.text("aA1é日-", max_size=40)))
def test_any_text_has_the_ids_of_the_library(text):
    assert np.frombuffer(bpe.codec(PATH).ids(text.encode()), "<i4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_every_token_that_its_text_gives_is_known():
    model = bpe.codec(PATH).model
    names = bpe.codec(PATH).names
    plain = [(i, names[i].removesuffix("</w>")) for i in model.length if names[i].endswith("</w>") and names[i].removesuffix("</w>").isascii() and names[i].removesuffix("</w>").isalpha()]
    assert len(plain) > 20_000
    assert all(model.encode(word) == [i] for i, word in plain)


def test_a_small_model_with_equal_pairs_in_a_row(tmp_path):
    """Merges by rank, done the plain way, for every short word over two letters."""
    merges = [("a", "a"), ("aa", "a"), ("a", "b"), ("b", "ab"), ("aa", "a</w>"), ("b", "b"), ("bb", "aa"), ("ab", "b</w>"), ("b", "bb"), ("aa", "ab")]
    base = ["a", "b", "a</w>", "b</w>"]
    vocab = {t: i for i, t in enumerate(base + ["".join(m) for m in merges])}
    model = bpe.WordModel({"type": "BPE", "end_of_word_suffix": "</w>", "vocab": vocab, "merges": merges})

    def plain(word: str) -> list[int]:
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            ranks = [merges.index(p) if p in merges else 99 for p in zip(parts, parts[1:])]
            if min(ranks, default=99) == 99:
                return [vocab[p] for p in parts]
            k = ranks.index(min(ranks))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    for length in range(1, 12):
        for bits in range(1 << length):
            word = "".join("ab"[bits >> k & 1] for k in range(length))
            assert model.encode(word) == plain(word), word
    with pytest.raises(ValueError):
        model.encode("abc")
    with pytest.raises(ValueError):
        bpe.WordModel({"type": "BPE", "end_of_word_suffix": "</w>", "vocab": vocab, "merges": merges[::-1]})


@KINDS
def test_encode_and_decode_documents(spark, clashing):
    data = corpus.rows() + [(2000 + i, t, None, None, None) for i, t in enumerate(TEXTS)]
    made = bpe.decode_documents(bpe.encode_documents(corpus.frame(spark, clashing, data), PATH), PATH)
    ids = [LIBRARY.encode(r[1] or "", add_special_tokens=False).ids for r in data]
    expected = Counter((r[0], r[1], tuple(i), LIBRARY.decode(i, skip_special_tokens=False)) for r, i in zip(data, ids))
    for way in (made, bpe.round_trip_documents(corpus.frame(spark, clashing, data), PATH)):
        assert Counter((r["doc_id"], r["text"], tuple(r["ids"]), r["decoded"]) for r in way.collect()) == expected
    assert bpe.encode_documents(corpus.frame(spark, clashing, data).limit(0), PATH).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([320, 999999, -1, 49407],)], "ids array<int>")
    assert [r[0] for r in bpe.decode_documents(odd, PATH).select("decoded").collect()] == ["", "", "a</w> <|endoftext|>"]


def test_the_query_equals_the_library(spark):
    found = {tuple(r) for r in contract.queries()["op13_bpe"](spark, SMALL).collect()}
    expected = set()
    for doc_id, text in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        expected.add((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    assert found == expected
