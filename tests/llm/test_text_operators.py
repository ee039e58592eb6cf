"""Each operator against brute force on a small corpus with nulls, repeats, ties, long and empty texts."""

from __future__ import annotations

import hashlib
import itertools
import random
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from llm import blocks, common, decontaminate, jaccard, lines, nbsvm, packing, pii, quality, substrings, tokenfiles, tokens, topk, toxicity  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

PATH = tokens.word_bpe_path()
KINDS = pytest.mark.parametrize("clashing", [False, True])


def counted(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def whole_ids(text: str | None) -> list[int]:
    return tokens.word_tokens(PATH).whole.encode(text or "", add_special_tokens=False).ids


# ------------------------------------------------------------------- tokens


@pytest.mark.parametrize("text", ["", "It's we'll DON'T İstanbul Σίσυφος", "<|endoftext|> x <|ENDOFTEXT|>", "12 345 ½ x2 日本語 🙂👍 foo_bar", "a b c é É é ÉT ſ Ꭰ", "x." * 300, "end,. ***|"])
def test_pieces_between_white_space_give_the_ids_of_the_whole(text):
    assert tokens.word_tokens(PATH).of(text.encode()).tolist() == whole_ids(text)


@KINDS
def test_token_counts(spark, clashing):
    data = corpus.rows()
    found = tokenfiles.token_counts(corpus.frame(spark, clashing), PATH).select("doc_id", "n_tokens").collect()
    assert counted(found) == Counter((r[0], len(whole_ids(r[1]))) for r in data)


def test_documents_across_many_small_blocks(spark):
    data = [(k, "word " * n) for k, n in enumerate([0, 1, 5, 700, 0, 33])] + [(-5, "below zero"), (None, "x")]
    found = tokenfiles.token_counts(spark.createDataFrame(data, "doc_id long, text string"), PATH, block_bytes=16)
    assert counted(found.select("doc_id", "n_tokens").collect()) == Counter((i, len(whole_ids(t))) for i, t in data)


def test_scan_of_a_foreign_file_with_an_open_end(spark, tmp_path):
    tokens_in = np.array([7, 7, 9, 7, 9, 9, 7], "<u4")
    (tmp_path / "a.bin").write_bytes(tokens_in.tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    found = tokenfiles.scan_token_files(spark, str(tmp_path), separator=9, width=4, block_bytes=8, suffix="*.bin")
    rows = found.orderBy("ordinal").select("ordinal", "start", "n_tokens", "closed").collect()
    assert [tuple(r) for r in rows] == [(0, 0, 2, True), (1, 3, 1, True), (2, 5, 0, True), (3, 6, 1, False)]
    with pytest.raises(ValueError):
        tokenfiles.scan_token_files(spark, str(tmp_path), width=4, block_bytes=6)


# -------------------------------------------------------------- classifiers


def labelled(n: int = 240) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(3)
    words = [f"w{k}" for k in range(80)]
    docs, labels = [], []
    for k in range(n):
        bad = k % 3 == 0
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        if bad:
            text[2:2] = ["xx!!", "xx!!", "grumble"]
        docs.append((k, " ".join(text), "en", "s", 1))
        labels.append((k, 0 if bad else 1, 1 if bad else 0))
    return docs, labels


@pytest.mark.parametrize("scores, label, threshold", [(quality.quality_scores, 1, 0.7), (toxicity.toxicity_scores, 2, 0.3)])
def test_held_out_rows_are_told_apart(spark, scores, label, threshold):
    docs, labels = labelled()
    docs += [(1000, None, None, None, None), (1001, "", None, None, None), (None, "w1 w2", None, None, None), docs[0]]
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    rows = scores(corpus.frame(spark, True, docs), marks).collect()
    assert len(rows) == len(docs)
    truth = {x[0]: x[label] for x in labels}
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_one_class_or_no_rows_give_the_share(spark):
    docs = corpus.frame(spark, data=labelled(12)[0])
    marks = spark.createDataFrame([(k, 1, 0) for k in range(12)], "doc_id long, quality int, toxic int")
    (score,) = {r["score"] for r in quality.quality_scores(docs, marks).collect()}
    assert score == pytest.approx(10 / 11, abs=0.05)
    assert quality.quality_scores(docs.limit(0), marks.limit(0)).count() == 0
    kept = toxicity.without_toxic(docs, marks.limit(0), threshold=0.6)
    assert kept.columns == docs.columns and kept.count() == 12


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = labelled(120)
    turned = [(k, 1 - q, 1 - t) if zlib.crc32(str(k).encode()) % 4 == 2 else (k, q, t) for k, q, t in labels]
    results = [
        {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(corpus.frame(spark, data=docs), spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()}
        for x in (labels, turned)
    ]
    assert results[0] == results[1]


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 3))
    y = np.where(x @ [1.0, -2.0, 0.5] + 0.3 > 0, 1.0, -1.0)
    y[:4] *= -1
    w, b = nbsvm.dual_coordinate_descent(np.arange(0, 121, 3), np.tile(np.arange(3), 40), x.ravel(), y, cost=0.5, epochs=3000, tolerance=1e-9)
    value = lambda w, b: (w @ w + b * b) / 2 + 0.5 * np.maximum(0, 1 - y * (x @ w + b)).sum()
    best = value(w, b)
    for _ in range(300):
        d = rng.normal(size=4) * 0.05
        assert value(w + d[:3], b + d[3]) >= best - 1e-6


# ------------------------------------------------------------ decontamination


def test_overlaps_survive_replaced_words(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [[word() for _ in range(n)] for n in (20, 40, 15, 6)]
    around = lambda words: " ".join([word() for _ in range(30)] + words + [word() for _ in range(30)])
    changed = list(items[1])
    for k in (4, 13, 22, 31):
        changed[k] = "other"
    docs = [(0, around(items[0])), (1, around(changed)), (2, around([w.upper() + "," for w in items[2]])), (3, around(items[3])), (4, around([])), (5, around(items[1][:9])), (6, None), (7, ""), (None, around(items[0])), (8, " ".join(items[0]))]
    docs.append(docs[0])
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(None, None), (9, "")], "item_id long, text string")
    frame = corpus.frame(spark, True, [(i, t, None, None, None) for i, t in docs])
    found = decontaminate.benchmark_overlaps(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["start"], r["length"], r["n_equal"]) for r in found} == {(0, 0, 30, 20, 20), (1, 1, 30, 40, 36), (2, 2, 30, 15, 15), (None, 0, 30, 20, 20), (8, 0, 0, 20, 20)}
    assert len(found) == 5
    assert decontaminate.benchmark_overlaps(frame, bench.limit(0)).count() == 0
    assert decontaminate.benchmark_overlaps(frame.limit(0), bench).count() == 0


def longest_stretch(same: list[bool], least: int) -> tuple[int, int, int]:
    """(length, -begin, equal) of the longest stretch that meets both limits, by trying all."""
    ends = [(e - b, -b, sum(same[b:e])) for b in range(len(same)) for e in range(b + 1, len(same) + 1) if same[b] and same[e - 1]]
    return max((x for x in ends if x[2] >= least and 5 * x[2] >= 4 * x[0]), default=(0, 0, 0))


def test_longest_overlap_equals_brute_force():
    rng = random.Random(6)
    for _ in range(2000):
        same = [rng.random() < 0.78 for _ in range(rng.randint(0, 45))]
        found = decontaminate.longest_overlap(np.array(same, bool), 12, Fraction(4, 5))
        length, begin, _ = longest_stretch(same, 12)
        assert found == ((-begin, -begin + length) if length else None)


def test_overlaps_survive_a_fifth_of_replaced_words(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    items, docs, expected, lost = [], [], set(), 0
    plans = [(n, rng.sample(range(n), n * share // 100)) for n in (15, 20, 30, 44, 59) for share in (15, 20) for _ in range(8)] + [(59, range(4, 59, 5))]
    for k, (n, places) in enumerate(plans):
        item, same = [word() for _ in range(n)], [x not in places for x in range(n)]
        items.append((k, " ".join(item)))
        docs.append((k, " ".join([word() for _ in range(20)] + [w if s else word() for w, s in zip(item, same)] + [word() for _ in range(20)]), None, None, None))
        length, begin, equal = longest_stretch(same, 12)
        hit = any(all(same[at + j] for j, bit in enumerate(mask) if bit == "1") for mask in decontaminate.MASKS for at in range(n - len(mask) + 1))
        if length and hit:
            expected.add((k, k, 20 - begin, -begin, length, equal))
            high = max(sum(1 if x else -4 for x in same[b:e]) for b in range(n) for e in range(b + 1, n + 1))
            lost += high < 12
    found = decontaminate.benchmark_overlaps(corpus.frame(spark, data=docs), spark.createDataFrame(items, "item_id long, text string"))
    assert counted(found.select("doc_id", "item_id", "start", "item_start", "length", "n_equal").collect()) == Counter(expected)
    assert len(expected) > 40 and lost > 10 and (80, 80, 20, 0, 59, 48) in expected


def test_large_benchmarks_take_the_same_path_to_the_same_rows(spark, monkeypatch):
    data = [(k, t, None, None, None) for k, t, *_ in corpus.rows() if t]
    bench = spark.createDataFrame([(k, t) for k, t, *_ in data[:6]], "item_id long, text string")
    few = counted(decontaminate.benchmark_overlaps(corpus.frame(spark, data=data), bench).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST", 0)
    assert counted(decontaminate.benchmark_overlaps(corpus.frame(spark, data=data), bench).collect()) == few and few


# -------------------------------------------------------------- personal data


EDGES = [
    (1, "a@b.c_d@e.f x.y@z_w@q.r.s"), (2, "1.2.3.4.5.6.7.8 0300.1.1.1 256.1.1.1 000255.1.1.01"), (3, None), (4, ""),
    (5, "é4111 1111-1111 1111 x 4111111111111112 +1 (2) 3.4-567890 ) +12 " + "9" * 3000), (6, "a" * 20000 + "@b.cc"),
    (7, "@@ a@@b.c @x.y 1" + " 1" * 3000), (None, "me@x.org"), (8, "+1 555 +2 66677788899 +3 44 555 66 77"), (7, "again 10.0.0.1"),
]


@KINDS
def test_base_spans(spark, clashing):
    data = [(i, t, None, None, None) for i, t in EDGES] + [EDGES[0] + (None,) * 3]
    found = pii.personal_data(corpus.frame(spark, clashing, data)).select("doc_id", pii.spans_text(F.col("base"))).collect()
    text = lambda t: ",".join(f"{k}:{a}:{b}" for k, a, b in corpus.base_spans(t))
    assert counted(found) == Counter((i, text(t)) for i, t, *_ in data)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    data = [(k, f"noise words here please call me +1 (555) 010-{1000 + k} then mail to user{k}@example.com soon") for k in range(12)]
    data += [(50, "so please call me 555-010-9999, thanks"), (51, "then mail to nobody(at)2024example soon"), (52, "the number 123456 is only a number"), (53, "order of 9999 pieces")]
    rows = pii.personal_data(spark.createDataFrame(data, "doc_id long, text string")).select("doc_id", "added").collect()
    added = {r["doc_id"]: [(x["kind"], x["s"], x["e"]) for x in r["added"]] for r in rows}
    assert added[50] == [("phone", 18, 30)]
    assert added[51] and added[51][0][0] == "email"
    assert all(not v for k, v in added.items() if k not in (50, 51))
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ------------------------------------------------------------- top-k search


def best_pairs(vectors, k, step):
    out = []
    for q, x in vectors:
        if q % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in vectors if v != q)
            out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 7)])
def test_top_k(spark, blocks):
    rng = np.random.default_rng(0)
    good = [(k, [float(v) for v in rng.normal(size=20)]) for k in range(90)] + [(100 + k, [0.5] * 20) for k in range(40)] + [(200, []), (205, [1.0]), (210, [3e5] * 20)]
    bad = [(300, None), (305, [1.0, None]), (310, [float("nan")]), (315, [float("inf")]), (None, [1.0])]
    df = spark.createDataFrame([(i, x, 1, 2) for i, x in good + bad], "vec_id long, embedding array<double>, rank int, score long").repartition(3)
    found = topk.exact_top_k(df, k=6, query_step=5, query_block=blocks[0], candidate_block=blocks[1])
    whole = [(i, [int(np.floor(64 * v)) for v in x]) for i, x in good]
    assert counted(found.select("query_id", "rank", "vec_id", "score").collect()) == Counter(best_pairs(whole, 6, 5))
    assert topk.exact_top_k(df.limit(0)).count() == 0


def test_top_k_of_repeated_query_rows(spark):
    """A repeated query row is one query; two vectors of one id are two."""
    rng = np.random.default_rng(2)
    good = [(k, [float(v) for v in rng.normal(size=8)]) for k in range(40)]
    rows = [*good, good[10], good[10], (20, [2.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = topk.exact_top_k(df, k=6, query_step=10, query_block=2, candidate_block=7)
    whole = [(i, [int(np.floor(64 * v)) for v in x]) for i, x in rows]
    queries = {(i, tuple(x)) for i, x in whole if i % 10 == 0}
    expected = []
    for i, x in queries:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in whole if v != i)
        expected += [(i, n + 1, v, -s) for n, (s, v) in enumerate(scored[:6])]
    assert counted(found.select("query_id", "rank", "vec_id", "score").collect()) == Counter(expected)


def test_bounds_never_fall_below_scores():
    rng = np.random.default_rng(4)
    q, c = rng.integers(-90, 90, (20, 33)), rng.integers(-90, 90, (30, 33))
    for parts in topk.LEVELS:
        assert (topk._stats(q, parts) @ topk._stats(c, parts).T + 1e-6 >= q @ c.T).all()


# ----------------------------------------------------------------- line dedup


@KINDS
def test_line_dedup(spark, clashing):
    df = corpus.frame(spark, clashing)
    found = lines.dedup_lines(df)
    assert set(df.columns) <= set(found.columns)
    expected = corpus.lines_removed(corpus.rows(), lines.NEAR_WORDS)
    assert counted(found.select("doc_id", "text", "n_lines", "n_removed").collect()) == Counter(expected)
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_neighbourhoods_meet_exactly_where_words_differ():
    words = [f"w{k}" for k in range(12)]
    texts = [words, [*words[:7], "other", *words[8:]], [*words[:5], *words[6:]], words]
    x = lines.scan_lines([b"first line\n \n" + " ".join(texts[0]).encode(), *(" ".join(t).encode() for t in texts[1:])])
    assert x.line.tolist() == [0, 2, 0, 0, 0] and x.text.tolist() == [0, 0, 1, 2, 3]
    n = x.stops - x.starts
    keys = lines.neighbourhood(x, np.arange(1, 5), n[1:], n[1:])
    of = {k: {int(e["at"]): int(e["h"]) for e in keys[keys["of"] == x.hashes()[k].view(np.int64)]} for k in (1, 2, 3)}
    assert [k for k in range(-1, 12) if of[1][k] == of[2][k]] == [7]
    assert of[1][5] == of[3][-1] and x.hashes()[1] == x.hashes()[4] != x.hashes()[2]
    first, last, third = x.halves()
    assert first[1] == first[2] and last[1] != last[2] and third[1] != third[2]


@pytest.mark.parametrize("a, b, near", [("a b c", "a b c", True), ("a b c", "a x c", True), ("a b c", "a c", True), ("b c", "a b c", True), ("a b", "b a", False), ("a b c d", "a x c y", False), ("", "a", True), ("a b c", "a", False)])
def test_one_apart(a, b, near):
    assert lines.one_apart(a.encode().split(), b.encode().split()) is near is corpus.one_apart(tuple(a.split()), tuple(b.split())) or a == b


# ----------------------------------------------------------- near duplicates


@KINDS
@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard_components(spark, clashing, width, percent):
    data = corpus.rows()
    found = jaccard.jaccard_components(corpus.frame(spark, clashing), width, percent).collect()
    assert counted(found) == Counter(corpus.jaccard_groups(data, width, percent))


def test_links_that_no_hub_has_are_found(spark):
    """Chains: each text is near the next only, so a hub connects few of its list."""
    words = [f"w{k}" for k in range(140)]
    data = [(k, " ".join(words[4 * k : 4 * k + 60]), None, None, None) for k in range(20)]
    found = jaccard.jaccard_components(corpus.frame(spark, data=data), 3, 75, hubs=1).collect()
    assert counted(found) == Counter(corpus.jaccard_groups(data, 3, 75))


def test_one_row_of_each_group_stays(spark):
    data = corpus.rows()
    kept = jaccard.one_of_each(corpus.frame(spark), 5, 80).collect()
    groups = defaultdict(set)
    for r, (_, n, component) in zip(data, corpus.jaccard_groups(data, 5, 80)):
        if n:
            groups[component].add(r[0])
    found = [r["doc_id"] for r in kept if corpus.shingles(r["text"], 5)]
    assert set(found) == set(groups) and len(found) == len(groups) + 1  # two different texts have the id 508
    assert jaccard.one_of_each(corpus.frame(spark).limit(0)).count() == 0


# ------------------------------------------------------------------- packing


@KINDS
def test_packing_round_trip(spark, clashing):
    data, capacity = corpus.rows(), 128
    found = packing.pack_documents(corpus.frame(spark, clashing), PATH, capacity).collect()
    expected = Counter()
    for doc_id, text, *_ in data:
        ids = np.array([*whole_ids(text), 0], "<u4")
        expected.update((doc_id, k, a, len(ids[a : a + capacity]), zlib.crc32(ids[a : a + capacity].tobytes())) for k, a in enumerate(range(0, len(ids), capacity)))
    assert counted(r[:5] for r in found) == expected
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    sizes = Counter(r["length"] for r in found)
    assert -(-sum(r["length"] for r in found) // capacity) <= len(bins) <= sum(n for _, n in packing.best_fit(dict(sizes), capacity))
    assert packing.pack_documents(corpus.frame(spark).limit(0), PATH).count() == 0


@pytest.mark.parametrize("counts, capacity, fewest", [({6: 3, 4: 3}, 10, 3), ({5: 2, 4: 2, 3: 2, 2: 3}, 10, 3), ({7: 4}, 10, 4), ({10: 2, 1: 1}, 10, 3), ({44: 1, 24: 2, 22: 1, 21: 1, 17: 1, 8: 2, 6: 2}, 100, 2), ({}, 10, 0)])
def test_fewest_sequences(counts, capacity, fewest):
    patterns = packing.pack_counts(counts, capacity)
    used = Counter()
    for pattern, times in patterns:
        assert sum(length * n for length, n in pattern) <= capacity
        used.update({length: n * times for length, n in pattern})
    assert used == Counter(counts) and sum(n for _, n in patterns) == fewest


def test_branch_and_bound_beats_best_fit():
    better = worse = 0
    rng = random.Random(11)
    for _ in range(60):
        counts = Counter(rng.randint(15, 60) for _ in range(30))
        first, best = (sum(n for _, n in p) for p in (packing.best_fit(dict(counts), 100), packing.pack_counts(dict(counts), 100)))
        better += best < first
        worse += best > first
    assert better and not worse


def fewest_of(counts: dict[int, int], capacity: int) -> int:
    """Fewest sequences by trying every piece in every sequence."""
    pieces, seen = sorted(Counter(counts).elements(), reverse=True), set()
    best = len(pieces)

    def place(k: int, rooms: tuple) -> None:
        nonlocal best
        if k == len(pieces):
            best = min(best, len(rooms))
        if k == len(pieces) or len(rooms) >= best or (k, rooms) in seen:
            return
        seen.add((k, rooms))
        for at in {room: i for i, room in enumerate(rooms) if room >= pieces[k]}.values():
            place(k + 1, tuple(sorted((*rooms[:at], rooms[at] - pieces[k], *rooms[at + 1 :]))))
        place(k + 1, tuple(sorted((*rooms, capacity - pieces[k]))))

    place(0, ())
    return best


@pytest.mark.parametrize("counts, capacity, fewest", [({4: 2, 3: 4}, 10, 2), ({820: 7, 614: 14}, 2048, 7), ({820: 500, 614: 1000}, 2048, 500), ({7: 3, 5: 6, 3: 3}, 20, 3)])
def test_fillings_with_fewer_copies_are_tried(counts, capacity, fewest):
    test_fewest_sequences(counts, capacity, fewest)


def test_search_equals_brute_force():
    rng = random.Random(1)
    for _ in range(600):
        capacity = rng.choice([10, 12, 20, 30, 50])
        counts = Counter(rng.randint(1, capacity) if rng.random() < 0.3 else rng.randint(max(1, capacity // 6), capacity // 2) for _ in range(rng.randint(1, 11)))
        test_fewest_sequences(dict(counts), capacity, fewest_of(counts, capacity))


def test_fillings_are_all_that_nothing_dominates():
    rng = random.Random(3)
    for _ in range(200):
        capacity, counts = 24, Counter(rng.randint(2, 14) for _ in range(rng.randint(1, 9)))
        table = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            table[length] = n
        found = [x for x in packing.fillings(table, capacity) if x]
        expected, lengths = set(), sorted(counts, reverse=True)
        for many in itertools.product(*[range(counts[x] + 1) for x in lengths]):
            room = capacity - sum(x * n for x, n in zip(lengths, many))
            left = [x for x, n in zip(lengths, many) if n < counts[x]]
            given = [x for x, n in zip(lengths, many) if n]
            if many[0] and room >= 0 and not any(x <= room for x in left) and not any(0 < y - x <= room for x in given for y in left):
                expected.add((room, tuple((x, n) for x, n in zip(lengths, many) if n)))
        assert set(found) == expected and len(found) == len(expected) and [w for w, _ in found] == sorted(w for w, _ in found)


# ------------------------------------------------------------ substring dedup


@KINDS
@pytest.mark.parametrize("width, deepest, shared", [(13, 13, 256), (13, None, 1), (4, 8, 2), (13, 13, 3)])
def test_repeated_windows_go(spark, clashing, width, deepest, shared):
    data = corpus.rows()
    found = substrings.remove_repeats(corpus.frame(spark, clashing), width, deepest, shared=shared).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert counted(found) == Counter(corpus.repeats_removed(data, width))


def test_levels_and_kept_words(spark):
    words = [f"w{k}" for k in range(60)]
    data = [(1, " ".join(words)), (2, " ".join(["x", *words[:30], "y"])), (3, "z"), (4, " ".join(words[40:55]))]
    rows = substrings.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), width=13, keep_text=True).collect()
    found = {r["doc_id"]: (r["longest"], r["kept"]) for r in rows}
    assert found == {1: (26, " ".join(words)), 2: (26, "x y"), 3: (0, "z"), 4: (13, "")}
    assert hashlib.sha256(b"x y").hexdigest() in {r["kept_sha256"] for r in rows}
    assert substrings.remove_repeats(corpus.frame(spark).limit(0), deepest=13).count() == 0


def test_windows_double_from_four_words(spark, monkeypatch):
    steps, extended = [], substrings._extended
    monkeypatch.setattr(substrings, "_extended", lambda before, level, *rest: steps.append((before, level)) or extended(before, level, *rest))
    words = [f"w{k}" for k in range(40)]
    data = [(1, " ".join(words)), (2, " ".join(["x", *words[:13], "y"])), (3, " ".join(["x", *words[20:32], "y", *words[3:8]])), (4, " ".join(words[30:34]))]
    rows = substrings.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), width=13, deepest=13, keep_text=True).collect()
    assert steps == [(4, 8), (8, 13)] and [substrings.ladder(n) for n in (1, 4, 5, 26)] == [[1], [2, 4], [3, 5], [4, 8, 16, 26]]
    assert {r["doc_id"]: r["kept"] for r in rows} == {1: data[0][1], 2: "x y", 3: data[2][1], 4: data[3][1]}


def calls_in(call) -> int:
    """Functions, of Python or C, that Python calls one by one."""
    count = 0

    def see(frame, event, arg):
        nonlocal count
        count += event in ("call", "c_call")

    sys.setprofile(see)
    try:
        call()
    finally:
        sys.setprofile(None)
    return count


def test_windows_are_extended_without_a_call_per_word():
    texts = [" ".join(f"w{k}_{j}" for j in range(2_000)).encode() for k in range(20)]
    texts[7] = texts[3]
    told = [np.sort(substrings.choices(substrings.scan_words([t]).words, 4, 13)) for t in texts]
    columns = {"doc": pa.array(range(20), pa.int64()), "text": pa.array(texts, pa.binary()), "hashes": pa.array([h.tobytes() if k in (3, 7) else b"" for k, h in enumerate(told)], pa.binary())}
    found: list = []
    send = substrings._extended(4, 8, 13, 8, 256)
    assert calls_in(lambda: found.extend(send(iter([pa.RecordBatch.from_pydict(columns)])))) < 2_000
    entries = substrings._of([v.as_buffer() for b in found for v in b.column(1)], substrings.ENTRIES)
    expected = np.unique(substrings.choices(substrings.scan_words([texts[3]]).words, 8, 13))
    for doc in (3, 7):
        assert np.sort(entries["h"][entries["doc"] == doc]).tolist() == expected.tolist()
    assert set(entries["doc"].tolist()) == {3, 7}


def test_words_and_windows_of_a_block():
    texts = [b"", b" a  bb\x00 a\tbb \n" + b"x" * 9, b"\r\n \x0b", b"a bb bb\x00 " + b"y" * 8 + b" " + b"y" * 70 + b"z " + b"y" * 70, b"yyyyyyyy", b"y" * 70 + b"z a"]
    x = substrings.scan_words(texts, True)
    assert [x.plain(k) for k in range(len(texts))] == [b" ".join(t.split()) for t in texts]
    words = [w for t in texts for w in t.split()]
    assert len({*zip(words, x.words.tolist())}) == len({*words}) == len({*x.words.tolist()})
    rng = np.random.default_rng(8)
    codes = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (40, 12, 13, 0)]
    for half, width in ((4, 13), (8, 13), (13, 13), (1, 1), (2, 4)):
        for c in codes:
            hashes = common.shingle_hashes(c, half)
            assert substrings.choices(c, half, width).tolist() == [min(hashes[k : k + width - half + 1]) for k in range(len(c) - width + 1)]
    x = substrings.scan_words([b"a b c", b"d e", b"", b"f g h i"])
    assert x.full(3).tolist() == [0, 5, 6] and x.full(20).tolist() == []
    hashes = np.concatenate([rng.integers(0, 1 << 62, 3_000), np.repeat(rng.integers(0, 1 << 62, 20), 50), (7 << 40) + rng.integers(0, 9, 50)]).astype(np.uint64)
    then = rng.integers(-3, 3, len(hashes))
    assert blocks.hash_order(hashes, then).tolist() == np.lexsort((then, hashes)).tolist() and not len(blocks.hash_order(hashes[:0], then[:0]))
    for bucket in (rng.integers(-300, 300, 2_000), rng.integers(0, 1 << 20, 2_000)):
        assert blocks.bucket_order(bucket).tolist() == np.argsort(bucket, kind="stable").tolist()


def test_word_hashes_forget_without_changing(monkeypatch):
    monkeypatch.setattr(common, "REMEMBERED", 3)
    table = common.WordHash()
    words = [b"a", b"b", b"c", b"d", b"a", b"e"]
    assert table.of(words).tolist() == [common.WordHash()[w] for w in words] and len(table) <= 3


def test_large_lists_are_connected_without_all_their_pairs(spark, monkeypatch):
    """A group of near copies in a chain of edits, and texts that share a passage and nothing else."""
    rng, words = random.Random(9), [f"word{k}" for k in range(3000)]
    passage = [rng.choice(words) for _ in range(40)]
    data = [(k, " ".join([*passage, *(rng.choice(words) for _ in range(rng.randint(10, 90)))])) for k in range(300)]
    copies, now = 260, [rng.choice(words) for _ in range(120)]
    for k in range(copies):
        now = list(now)
        now[rng.randrange(len(now))] = rng.choice(words)
        data.append((1000 + k, " ".join([*passage, *now])))
    rng.shuffle(data)
    made, plain = [], jaccard._crossing

    def counted_pairs(*given):
        crossed = plain(*given)
        made.append(crossed.filter("a IS NOT NULL").count())
        return crossed

    monkeypatch.setattr(jaccard, "_crossing", counted_pairs)
    monkeypatch.setattr(jaccard, "MEMBERS", 64)
    found = jaccard.jaccard_components(spark.createDataFrame(data, "doc_id long, text string"), 4, 85, hubs=1)
    assert counted(found.collect()) == Counter(corpus.jaccard_groups([(i, t) for i, t in data], 4, 85))
    assert made and sum(made) < 40 * len(data)  # all pairs of the copies alone would be 33,670 a list


def test_most_alike_pairs_of_two_components():
    low, size = np.array([8, 9, 5, 7, 9]), np.array([10, 10, 10, 10, 10])
    chosen = jaccard.most_alike(low, size, np.array([1, 2, 1, 3, 1]), np.array([2, 1, 2, 1, 3]), 1)
    assert sorted(chosen.tolist()) == [1, 4]
    assert sorted(jaccard.most_alike(low, size, np.array([1, 2, 1, 3, 1]), np.array([2, 1, 2, 1, 3]), 2).tolist()) == [0, 1, 3, 4]


# ------------------------------------------------------- memory of one worker


def peak_mb(call) -> float:
    """Most that Python and numpy held at once, beside what they held before."""
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_packed_entries_leave_in_small_batches():
    rng = np.random.default_rng(3)
    parts = []
    for _ in range(3):
        parts.append(np.zeros(400_000, lines.ENTRY))
        parts[-1]["h"], parts[-1]["of"] = rng.integers(0, 1 << 63, 400_000) * 2, np.arange(400_000)
    batches = list(blocks.packed(iter(parts), 148))
    assert len(batches) > 4 and max(b.nbytes for b in batches) < 1.2 * blocks.SENT
    rows = [(k, v) for b in batches for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert [k for k, _ in rows] == list(range(148))
    every = np.concatenate(parts)
    every = every[np.argsort(blocks.bucket_of(every["h"], 148), kind="stable")]
    assert b"".join(v for _, v in rows) == every.tobytes()
    one = np.zeros(300_000, lines.ENTRY)  # a bucket is not divided, however large
    assert [b.num_rows for b in blocks.packed(iter([one]), 8)] == [1] and list(blocks.packed(iter([one[:0]]), 8)) == []


def test_lines_are_scanned_in_little_memory():
    texts = [" ".join(f"word{k * j % 97}" for k in range(600)).encode() for j in range(800)]
    ids = pa.array(range(800), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts, pa.binary())], ["doc", "key", "text"])
    lines._powers(1)  # kept per worker
    found: list = []
    assert peak_mb(lambda: found.extend(b.num_rows for b in lines._line_scan(iter([batch])))) < 100
    assert sum(found) == 800


def test_a_block_of_lines_is_scanned_by_word():
    """Numbers are made per word; per byte there are only flags."""
    texts = [" ".join(f"word{k * j % 97}" for k in range(600)).encode() for j in range(100)]
    lines.scan_lines(texts)  # powers are kept per worker
    assert peak_mb(lambda: lines.scan_lines(texts)) * 1e6 < 25 * sum(map(len, texts))


def test_a_model_is_fitted_in_little_more_than_its_rows():
    rng = np.random.default_rng(5)
    made = [np.unique(rng.integers(0, 1 << nbsvm.BITS, 40_000).astype(np.int32)) for _ in range(200)]
    mb = sum(r.nbytes for r in made) / 1e6
    rows = list(made)
    assert peak_mb(lambda: nbsvm.fit(rows, np.arange(200) % 2, 0.5)) < 5 * mb
    some = np.concatenate(made[:60])
    assert (nbsvm._counts(some) == np.bincount(some, minlength=1 << nbsvm.BITS)).all()
    assert not nbsvm._counts(some[:0]).any()
