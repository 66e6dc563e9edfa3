"""Cross-tokenizer alignment, hard negatives and packing by column generation, against plain computations."""

import collections
import zlib

import duckdb
import numpy as np
import pytest
from corpus import documents, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from logweave.llm import column_packing, cutting_stock, hard_negatives, token_alignment
from logweave.llm.byte_bpe import _SETTLED, ByteBpe

P = pytest.importorskip("public_tokenizers")
BYTES, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["▁a b", "a▁b", "<|endoftext|> x<|endoftext|>", "a\0b", "  two  spaces ", "\n\n a\tb", "<0x41> b", "日本語 テスト", "😀 x",
       "é ﬁ ½ é", " ", "a" * 400, "</s> [INST] <s>", "tab\t end ", "x　y", " " * 1500 + "q", "it's 'S don't’s",
       "١٢٣ a²b", "𝒳 ‍ ԱԲ", "\r\n\x0b\x1c"]


def key(row):
    return [str(x) for x in row]


# -- byte-level BPE -------------------------------------------------------------

@pytest.mark.parametrize("plain", [False, True])
def test_byte_bpe_equals_the_library(plain):
    bpe = ByteBpe(BYTES, plain)
    texts = [t or "" for _, t in documents()] + ODD
    assert bpe.fast is not None
    assert bpe.encode(texts) == [e.ids for e in bpe.tok.encode_batch(texts, add_special_tokens=False)]
    if plain:
        assert all(b"".join(bpe.bytes_of[i] for i in ids) == t.encode() for t, ids in zip(texts, bpe.encode(texts)))


def test_byte_bpe_settled_characters_are_classed_alike():
    bpe = ByteBpe(BYTES)
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and _SETTLED.fullmatch(chr(c))]
    texts = ["".join(f"a{c}b {c}1{c} {c}{c}\n" for c in chars[k:k + 500]) for k in range(0, len(chars), 500)]
    assert bpe.encode(texts) == [e.ids for e in bpe.tok.encode_batch(texts, add_special_tokens=False)]


# -- alignment --------------------------------------------------------------------

@pytest.fixture(scope="module")
def aligned_docs():
    rows = [(i, t if t is None or len(t) < 4000 else t[:4000]) for i, t in documents()]
    return rows + [(9000 + k, t) for k, t in enumerate(ODD)]


def test_alignment_equals_byte_ranges(docs_table, aligned_docs, monkeypatch):
    want = sorted(token_alignment.brute_force(aligned_docs, BYTES, PIECES), key=key)
    df = docs_table(aligned_docs)
    got = sorted((tuple(r) for r in token_alignment.align_tokens(df, BYTES, PIECES).collect()), key=key)
    assert got == want
    assert sum(r[1] == 0 for r in got) >= 4  # null, empty and a text that a vocabulary cannot spell
    monkeypatch.setattr(token_alignment, "BLOCK_PAIRS", 300)  # many blocks of the count table
    monkeypatch.setattr(token_alignment, "TASK_PAIRS", 200)
    assert sorted((tuple(r) for r in token_alignment.align_tokens(df, BYTES, PIECES).collect()), key=key) == want


def test_alignment_of_a_very_long_text_and_an_empty_table(docs_table):
    import random

    text = sentence(random.Random(5), 60_000) + "x" * 200_000
    (r,) = token_alignment.align_tokens(docs_table([(1, text)]), BYTES, PIECES).collect()
    a, b = ByteBpe(BYTES, True), token_alignment.PieceBpe(PIECES)
    assert (r.n_a, r.n_b) == (len(a.encode([" " + text])[0]), len(b.encode([text])[0]))
    assert r.n_best >= 1 and r.count_sum == r.n_links  # one document: every count is 1, so every link is the best of its id
    assert r.n_best == r.n_links
    assert token_alignment.align_tokens(docs_table([]), BYTES, PIECES).collect() == []


def test_windows_longer_than_the_memory_takes():
    aligner = token_alignment.Aligner(BYTES, PIECES)
    text = "a" * 3000
    before = len(aligner.memo)
    (row,) = aligner.align([text])
    assert row[0] > token_alignment.MEMO_LENGTH and len(aligner.memo) == before


# -- hard negatives ---------------------------------------------------------------

def plain_negatives(rows):
    part = [(a, (c + 1) % 10 if a % 7 == 0 else c, [int(np.floor(256 * x)) for x in b]) for a, b, c in rows
            if a is not None and c is not None and b and all(x is not None and np.isfinite(x) for x in b)]
    out = []
    for i, (anchor, label, x) in enumerate(part):
        if anchor % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), v, other == label) for j, (v, other, y) in enumerate(part) if j != i and len(y) == len(x)]
        for s, v in sorted((s, v) for s, v, same in scored if same)[:5]:
            found = sorted((t, w) for t, w, same in scored if not same and 80 * -s <= 100 * -t <= 100 * -s)[:5]
            out += [(anchor, v, k, w, -s, -t) for k, (t, w) in enumerate(found, 1)]
    return sorted(out, key=key)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = [(i * (50 if i % 3 else 100), [float(x) for x in rng.normal(size=4)], i % 4) for i in range(120)]
    rows += [rows[3], rows[3], rows[6], (None, [1.0, 2.0, 3.0, 4.0], 1), (700, None, 1), (800, [1.0, None, 1.0, 1.0], 1),
             (900, [float("nan")] * 4, 1), (901, [float("inf")] * 4, 1), (1000, [1.0, 2.0, 3.0, 4.0], None), (1100, [], 1),
             (1200, [1.0, 2.0], 1), (1201, [1.0, 2.5], 1), (1203, [1.0, 2.0], 2), (71300, [1e6, -3e6, 2e6], 1), (71301, [1e6, -3e6, 1e6], 1),
             (71303, [1e6, -3e6, 1e6 - 1], 2)]
    # many ties: one vector under two labels
    return rows + [(20_000 + k, [0.5] * 4, 2 + k % 2) for k in range(60)] + [(30_000, [0.5] * 4, 2)]


def test_hard_negatives_equal_all_pairs_and_sql(spark, vectors, monkeypatch, tmp_path):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 5)
    monkeypatch.setattr(hard_negatives, "TILE", 2)
    monkeypatch.setattr(hard_negatives, "ROWS", 7)
    df = spark.createDataFrame([(a, b, c, "x", 1, 2.0) for a, b, c in vectors],
                               "vec_id long, embedding array<double>, label int, raw string, row int, score double").repartition(4)
    got = sorted((tuple(r) for r in hard_negatives.mine(df, hard_negatives.moved_label()).collect()), key=key)
    assert got == plain_negatives(vectors)
    assert len({r[1] for r in got}) > 50
    # SQL multiplies in doubles, which do not hold the products of the large vectors (they meet only each other)
    large = (71300, 71301, 71303)
    df.select("vec_id", "embedding", "label").where("vec_id is null or vec_id not in (71300, 71301, 71303)").write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    assert sorted(con.execute(hard_negatives.SQL).fetchall(), key=key) == [r for r in got if r[0] not in large]


def test_hard_negatives_of_no_rows_and_no_anchors(spark):
    kind = "vec_id long, embedding array<double>, label int"
    assert hard_negatives.mine(spark.createDataFrame([], kind)).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], kind)).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(100, [1.0], 1)], kind)).collect() == []
    # a component beyond 32 bits keeps its row out
    rows = [(100, [1.0], 1), (101, [1.0], 1), (102, [1e300], 2), (103, [1.0], 2)]
    assert [tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, kind)).collect()] == [(100, 101, 1, 103, 65536, 65536)]


def test_best_keeps_ties_by_id():
    best = hard_negatives.Best(1, 1, 3)
    zero = np.zeros(4, np.int64)
    best.add(zero, np.array([5, 5, 5, 5]), np.array([9, 2, 7, 4]))
    best.add(zero, np.array([5, 6, 4, 5]), np.array([1, 8, 0, 3]))
    assert [x.tolist() for x in best.lists[1:]] == [[6, 5, 5], [8, 1, 2]]


# -- column generation ------------------------------------------------------------

def spent(patterns, left):
    out = left.copy()
    for p in patterns:
        out[p.length] += p.times * p.count
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=120))
def test_patterns_hold_every_item_and_the_left_fill_all_gaps(lengths):
    need = np.bincount(lengths, minlength=33).astype(np.int64) if lengths else np.zeros(33, np.int64)
    patterns, left = cutting_stock.solve(need, 32)
    assert (left >= 0).all() and (spent(patterns, left) == need).all()
    assert all(p.fill <= 32 and p.times > 0 for p in patterns)
    assert sum(p.times * cutting_stock.gap_of(p, 32) for p in patterns) <= left @ np.arange(33)


def test_knapsack_is_the_best_of_all_fills():
    rng = np.random.default_rng(1)
    value = np.full(13, -np.inf)
    value[[2, 3, 5, 9]] = rng.random(4)
    best, last = cutting_stock.knapsack(value, 12)
    for fill in range(13):
        plain = [-np.inf] * 12 + [0.0]

        def most(f):
            return 0.0 if f == 0 else max((value[x] + most(f - x) for x in (2, 3, 5, 9) if x <= f), default=-np.inf)
        assert best[fill] == pytest.approx(most(fill)) if np.isfinite(most(fill)) else best[fill] == -np.inf
        if np.isfinite(best[fill]):
            assert sum(cutting_stock._items(last, fill)) == fill
    assert len(plain) == 13


def test_pricing_improves_on_the_greedy_start():
    need = np.zeros(101, np.int64)
    need[[45, 36, 31, 14]] = [97, 610, 395, 211]  # a classic of the cutting-stock problem: 452.25 sequences
    program = cutting_stock._Program(need, 100)
    before = float(program.costs @ program.x)
    program.solve()
    after = float(program.costs @ program.x)
    assert after < before
    # no column has a gain left, so the program is solved: prices times needs are its value
    assert program.priced() == []
    assert after == pytest.approx(float(program.price @ program.need))


def packed_rightly(got, docs, capacity, end):
    bpe = ByteBpe(BYTES)
    ids = [i + [end] for i in bpe.encode([t or "" for _, t in docs])]
    want = collections.Counter((d, len(i)) for (d, _), i in zip(docs, ids))
    by_doc, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
        assert 0 < r.length <= capacity
    assert by_doc.keys() == want.keys()
    own = collections.defaultdict(list)
    for (d, _), i in zip(docs, ids):
        own[d, len(i)].append(i)
    for k, rows in by_doc.items():
        cover = collections.Counter()
        for r in rows:
            assert any(zlib.crc32(np.array(i[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for i in own[k])
            cover.update(range(r.start, r.start + r.length))
        assert cover == collections.Counter({p: want[k] for p in range(k[1])})
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at & (at - 1) == 0, "padding"
    return sequences


@pytest.mark.parametrize("capacity", [16, 64, 2048])
def test_column_packing_covers_every_id_without_padding(docs_table, capacity):
    docs = documents() + [(9000 + k, t) for k, t in enumerate(ODD)]
    got = column_packing.pack(docs_table(docs, 5), BYTES, capacity).collect()
    packed_rightly(got, docs, capacity, 1)


def test_column_packing_of_equal_lengths_and_no_rows(docs_table):
    docs = [(k, "a b c d e f g h i j k") for k in range(60)]  # 12 tokens each: no two fit into 16
    sequences = packed_rightly(column_packing.pack(docs_table(docs, 4), BYTES, 16).collect(), docs, 16, 1)
    assert len(sequences) == 45  # all full
    assert column_packing.pack(docs_table([]), BYTES, 16).collect() == []
    assert len(column_packing.pack(docs_table([(None, None)]), BYTES, 16).collect()) == 1
