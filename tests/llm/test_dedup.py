"""Line dedup, n-gram Jaccard join, substring dedup and embedding near-dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from corpus import documents, sentence

from logweave.llm import embedding_dedup, graph, jaccard_join, line_dedup, substring_dedup, wordhash

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def lines_by_hand(rows, min_docs=5, min_chars=40):
    held = defaultdict(set)
    for i, t in rows:
        for x in {key_of(x) for x in (t or "").split("\n")}:
            if len(x) >= min_chars:
                held[x].add((-1 if i is None else i, t))
    last = {k: max(d for d, _ in v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(key_of(x), -1 if i is None else i) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return out


def by_null(rows):
    return sorted(rows, key=lambda t: [(x is not None, x) for x in t])


def test_line_dedup_matches_the_plain_way(docs_table, rows_of):
    rows = documents()
    docs = docs_table(rows)
    want = lines_by_hand(rows)
    pairs = line_dedup.with_bitmaps(docs, line_dedup.line_bitmaps(docs))
    got = pairs.select("row.doc_id", "lines.n_lines", "lines.n_dropped").collect()
    assert by_null(map(tuple, got)) == by_null(w[:3] for w in want)
    assert sum(w[2] for w in want) > 50
    out = line_dedup.drop_lines(docs)
    assert out.columns == docs.columns
    assert by_null((r.doc_id, r.text or "") for r in out.collect()) == by_null((w[0], w[4]) for w in want)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())


def test_line_bitmaps_of_an_empty_table(docs_table):
    docs = docs_table([(1, "x")]).where("doc_id > 1")
    assert line_dedup.line_bitmaps(docs).count() == 0
    assert line_dedup.drop_lines(docs).columns == docs.columns


def test_line_dedup_oracle_on_small_tables(spark, sf_dir):
    got = line_dedup.query(spark, sf_dir).toPandas().sort_values("doc_id")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = con.sql(line_dedup.ORACLE).df().sort_values("doc_id")
    assert got.values.tolist() == want[got.columns].values.tolist()


def test_line_dedup_has_no_python_in_its_plan(spark, sf_dir):
    plan = line_dedup.query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_jaccard_components_match_brute_force(docs_table, rows_of):
    rows = [(i, t) for i, t in documents() if i is not None]
    got = jaccard_join.jaccard_components(docs_table(rows)).select("doc_id", "n_shingles", "component_id")
    want = set(jaccard_join.brute_force(rows))
    assert set(rows_of(got)) == want
    assert sum(c != d for d, _, c in want) > 20


def test_jaccard_group_of_near_copies_whose_members_do_not_all_link(docs_table, rows_of):
    rng = random.Random(4)
    base = sentence(rng, 150).split()
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(150)] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = jaccard_join.jaccard_components(docs_table(rows)).select("doc_id", "n_shingles", "component_id")
    assert rows_of(got) == sorted(jaccard_join.brute_force(rows))


def test_jaccard_threshold_is_exact():
    assert jaccard_join.required(10, 10, 80) == 9
    query, other = np.arange(90, dtype=np.uint64), np.arange(10, 100, dtype=np.uint64)
    assert jaccard_join.divide_skip(query, 19, [other, query, np.arange(9, 90, dtype=np.uint64)], 80) == [True, True, True]
    assert jaccard_join.divide_skip(query, 19, [np.arange(11, 101, dtype=np.uint64)], 80) == [False]


def test_jaccard_null_ids_empty_tables_and_one_per_group(docs_table, rows_of):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, None), (8, ""), (9, None), (9, None), (7, "a b c d e f"), (3, "x")]
    docs = docs_table(rows)
    got = rows_of(jaccard_join.jaccard_components(docs).select("doc_id", "n_shingles", "component_id"))
    assert got == [(None, 0, None), (None, 2, 7), (3, 1, 3), (7, 2, 7), (8, 0, 8), (9, 0, 9)]
    kept = jaccard_join.one_per_group(docs)
    assert kept.columns == docs.columns
    assert by_null(set((r.doc_id, r.text) for r in kept.collect())) == by_null(
        {(None, "a b c d e f"), (None, None), (3, "x"), (7, "a b c d e f"), (8, ""), (9, None)})
    none = docs.where("doc_id > 100")
    assert jaccard_join.jaccard_components(none).count() == 0
    assert jaccard_join.one_per_group(none).count() == 0


def test_jaccard_one_per_group_keeps_one_of_equal_rows(docs_table):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (8, ""), (8, ""), (9, None), (9, None),
            (None, None), (3, "x"), (12, "a b c d e f"), (8, "q r s t u v")]
    kept = jaccard_join.one_per_group(docs_table(rows, 5))
    assert by_null((r.doc_id, r.text) for r in kept.collect()) == by_null([
        (None, None), (None, "a b c d e f"), (3, "x"), (7, "a b c d e f"), (8, ""), (8, "q r s t u v"), (9, None)])
    assert "collect_set" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_components_of_a_long_chain_and_a_hub(spark, rows_of):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 260)] + [(1, 1), (9, 8), (8, 9)]
    got = dict(rows_of(graph.components(spark.createDataFrame(edges, "a long, b long"))))
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 5 for i in range(200, 260)) and got[9] == got[8] == 8
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substring_dedup_matches_brute_force(docs_table, rows_of):
    rows = documents(2)
    got = rows_of(substring_dedup.repeated_words(docs_table(rows)))
    want = by_null(substring_dedup.brute_force(rows))
    assert got == want
    assert sum(w[2] for w in want) > 1000
    assert substring_dedup.repeated_words(docs_table(rows).where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("shift", range(7))
def test_substring_matches_of_exactly_one_window_at_every_alignment(docs_table, rows_of, shift):
    window = [f"m{i}" for i in range(13)]
    rows = [(1, " ".join([f"a{i}" for i in range(20)] + window + ["z"])),
            (2, " ".join([f"b{i}" for i in range(shift)] + window)), (3, " ".join([f"c{i}" for i in range(9)] + window[:12]))]
    assert [r[2] for r in rows_of(substring_dedup.repeated_words(docs_table(rows, 2)))] == [0, 13, 0]


def test_substring_of_repeated_words(docs_table, rows_of):
    rows = [(1, "x y " * 40), (2, "a b " + "x y " * 30 + "c"), (3, "x y " * 13 + "tail"), (4, "y " * 50), (5, "q y " + "y " * 30), (5, "other " + "y " * 14)]
    got = rows_of(substring_dedup.repeated_words(docs_table(rows, 4)))
    assert got == sorted(substring_dedup.brute_force(rows)) and sum(g[2] for g in got) > 100


def test_substring_texts_that_share_an_id(docs_table, rows_of):
    """Thousands of different texts under one id and under none, some repeated: no text answers for another."""
    rng = np.random.default_rng(5)
    passages = [" ".join(f"p{k}w{i}" for i in range(13)) for k in range(6)]
    rows = [(k, f"first {p} tail") for k, p in enumerate(passages[:4])]
    for n in range(5000):
        own = " ".join(f"n{n}w{i}" for i in range(rng.integers(0, 20)))
        rows.append((10 if n % 2 else None, f"{own} {passages[n % 6]} z" if n % 7 == 0 else own))
    rows += rows[4:300] + [(11, "q " + passages[4]), (11, passages[5]), (11, passages[5]), (11, " ".join(f"u{i}" for i in range(20)))]
    got = rows_of(substring_dedup.repeated_words(docs_table(rows)))
    assert got == by_null(substring_dedup.brute_force(rows)) and len({g[2] for g in got}) > 1


def test_difference_cover():
    assert all(any((a + d) % 7 in substring_dedup.COVER for a in substring_dedup.COVER) for d in range(7))


def vectors(n=400, dims=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    near = np.repeat(base[:8], 60, axis=0) + rng.normal(size=(480, dims)) * 0.12
    rows = [(i, list(map(float, v))) for i, v in enumerate(np.vstack([base, near]).astype(np.float32))]
    rows += [(5000 + i, rows[0][1]) for i in range(100)] + [(6000, None), (6001, [0.0] * dims), (6002, [float("nan")] * dims),
             (6003, [None] + [1.0] * (dims - 1)), (6004, [float("inf")] + [1.0] * (dims - 1)), (6005, [])]
    return rows


def test_embedding_links_match_brute_force(spark, rows_of):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, 2, "r") for i, v in rows], "vec_id long, embedding array<float>, label int, cid int, raw string")
    got, want = rows_of(embedding_dedup.near_duplicates(df)), sorted(embedding_dedup.brute_force(rows))
    n = sum(w[1] for w in want)
    assert sum(min(g[1], w[1]) for g, w in zip(got, want)) >= 0.99 * n and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.99 * len(want)
    assert [g for g in got if g[0] >= 6000] == [(i, 0, i, True) for i in range(6000, 6006)]


def test_embedding_edge_cases(spark, rows_of):
    kind = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(4, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.0]), (3, [1.0, 0.0, 0.0]),
                                (None, None), (9, [-1.0, 0.0])], kind)
    assert rows_of(embedding_dedup.near_duplicates(df)) == [
        (None, 0, None, True), (None, 3, 2, False), (2, 3, 2, True), (2, 3, 2, True), (3, 0, 3, True), (4, 3, 2, False), (9, 0, 9, True)]
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], kind)).count() == 0


def isolated_pairs(n, pairs, dims=32, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=(pairs, dims))
    near = x[:pairs] + 0.28 * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    return [(i, list(map(float, v))) for i, v in enumerate(np.vstack([x, near]))]


def test_embedding_search_that_falls_short_ends_in_a_full_comparison(spark, rows_of, monkeypatch):
    for name, value in (("TREES", 1), ("MOST_TREES", 1), ("BLOCK", 4), ("ROUNDS", 1), ("EXTRA_ROUNDS", 0), ("EXACT_BLOCK", 300), ("EXACT_ROWS", 100)):
        monkeypatch.setattr(embedding_dedup, name, value, raising=False)
    rows = isolated_pairs(600, 200)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(embedding_dedup.brute_force(rows))
    assert sum(w[1] for w in want) > 300
    assert rows_of(embedding_dedup.near_duplicates(df)) == want


def test_embedding_forest_grows_with_the_table():
    trees = [embedding_dedup._trees(n, 0.95) for n in (1, 1_000, 10_000, 200_000, 10**7, 10**12)]
    assert trees == sorted(trees) and trees[0] == embedding_dedup.TREES and trees[3] >= 12 and trees[-1] == embedding_dedup.MOST_TREES


def test_embedding_audit_sees_missed_pairs_beside_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "RECALL", 0.995)
    rng = np.random.default_rng(8)
    base = rng.normal(size=32)
    group = [list(map(float, base + rng.normal(size=32) * 0.05)) for _ in range(600)]
    rows = [v for _, v in isolated_pairs(1000, 20)] + group
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.95
    linked = [(i, int(hit[i].sum()) - 1) for i in range(1020, len(rows))]  # the pairs are missed
    vectors = spark.createDataFrame([(i, bytearray(np.array(v).tobytes()), 1) for i, v in enumerate(rows)], "cid long, raw binary, weight long")
    counted = spark.createDataFrame(linked, "cid long, linked long")
    assert embedding_dedup._audit(vectors, counted, 32, 0.95) < 0.5
    monkeypatch.setattr(embedding_dedup, "AUDIT_BYTES", 8 * 32 * 50, raising=False)
    alone = vectors.where("cid >= 20 and cid < 1000")
    assert embedding_dedup._audit(alone, counted, 32, 0.95) is None


def test_words_are_hashed_together_without_a_memory():
    """A word's hash depends on its bytes alone; texts, blanks and nulls give the words that one text after another gives."""
    rng = random.Random(4)
    words = ["", "a", "\x00", "\x00\x00", "12345678", "123456789", "é" * 130, "x" * 256, "x" * 257, "y" * 5000]
    words += ["".join(rng.choice("abé\x00") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    words = sorted(set(words))
    for kind in (pa.string(), pa.binary(), pa.large_string()):
        own = wordhash.hashes_of(pa.array([w.encode() for w in words]).cast(kind))
        assert len(set(own.tolist())) == len(words)
        back = wordhash.hashes_of(pa.array(["skip", *[w for w in reversed(words)]]).cast(kind).slice(1))
        assert (back[::-1] == own).all()
    hash_of = dict(zip(words, own.tolist()))
    assert wordhash.hashes_of(pa.array([], pa.string())).tolist() == []
    texts = [None, "", "  ", " a  x\n", "\ta\x0ba", "x" * 257 + "\r1234567 12345678", "é" * 130]
    more = {w: int(wordhash.hashes_of(pa.array([w]))[0]) for w in ("x", "1234567")}
    codes, sizes = wordhash.hashed_words(pa.array(texts).slice(0))
    assert sizes.tolist() == [0, 0, 0, 2, 2, 3, 1]
    assert codes.tolist() == [(hash_of | more)[w] for t in texts for w in (t or "").split()]
    assert wordhash.hashed_words(pa.array([None, ""], pa.string()))[1].tolist() == [0, 0]
    assert wordhash.hashed_words(pa.array([], pa.string()))[1].tolist() == []
