"""Decontamination, packing, token counts, chat formatting and classifiers."""

import hashlib
import json
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus import WORDS, documents, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from logweave.llm import chat, decontaminate, packing, quality, token_counts, toxicity
from logweave.llm.common import scratch_path
from logweave.llm.fm_index import FMIndex, suffix_array

P = pytest.importorskip("public_tokenizers")


# -- benchmark decontamination ------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=12), min_size=1, max_size=8), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=5), min_size=1, max_size=6))
def test_fm_index_finds_every_occurrence(segments, patterns):
    text = np.array([x for s in segments for x in [*s, 0]], np.int64)
    index = FMIndex(text, 5, sample=4)
    width = max(map(len, patterns))
    padded = np.array([[0] * (width - len(p)) + p for p in patterns], np.int64)
    low, high = index.search(padded, np.array([len(p) for p in patterns]))
    for p, s, e in zip(patterns, low, high):
        want = [i for i in range(len(text) - len(p) + 1) if text[i:i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(s, e)).tolist()) == want


def test_suffix_array_of_long_repeats():
    text = np.array(([1, 2] * 500 + [0]) * 3, np.int64)
    order = suffix_array(text)
    seps = np.cumsum(text == 0)
    key = np.where(text == 0, seps, text + 10).tolist()  # separators differ, and are the smallest
    assert order.tolist() == sorted(range(len(text)), key=lambda i: key[i:i + 1100])


def contaminated(rng):
    items = [(i, sentence(rng, n)) for i, n in enumerate([30, 12, 10, 9, 4, 2, 0, 15])]
    items += [(None, items[0][1]), (3, "Quartz, RIVER-stone!"), (99, None), (98, ""), (1, sentence(rng, 11))]
    docs = documents(5, 30)
    for k, (_, t) in enumerate(items):
        docs.append((7000 + k, f"{sentence(rng, 20)} {(t or '').upper()} {sentence(rng, 5)}. {t}"))
    docs.append((8000, " ".join(items[0][1].split()[5:15])))
    docs.append((8001, " ".join(items[0][1].split()[5:14])))
    return items, docs


@pytest.mark.parametrize("block_words, shard_words", [(500_000, 4_000_000), (20, 300)])
def test_decontamination_matches_brute_force(spark, docs_table, rows_of, monkeypatch, block_words, shard_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard_words)
    items, rows = contaminated(random.Random(6))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(docs_table(rows), bench).select("row.doc_id", "found.n_words", "found.spans", "found.items")
    got = [(r[0], r[1], sum(s.end - s.start for s in r[2]), len(r[3]), ",".join(sorted(r[3]))) for r in got.collect()]
    want = decontaminate.brute_force(rows, items)
    names = {w[:4]: w[4] for w in want}
    key = lambda t: [(x is not None, x) for x in t[:4]]
    assert sorted((g[:4] for g in got), key=key) == sorted((w[:4] for w in want), key=key)
    assert all(hashlib.sha256(g[4].encode()).hexdigest() == names[g[:4]] for g in got if g[0] is not None and g[0] >= 7000)
    assert sum(w[5] for w in want) > 10


def test_decontamination_removes_the_spans_and_nothing_else(spark, docs_table):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    rows = [(1, "Start, é: A b. C d-e f g h I j k! End"), (2, None), (3, ""), (4, "clean  text\n"), (5, "a b c d e f g h i j"), (5, "a b c d e f g h i j")]
    docs = docs_table(rows)
    out = decontaminate.remove_contamination(docs, bench)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text or "", r.n_chars or 0) for r in out.collect()) == [
        (1, "Start, é: ! End", 15), (2, "", 0), (3, "", 0), (4, "clean  text\n", 12), (5, "", 0), (5, "", 0)]
    assert decontaminate.remove_contamination(docs, bench.where("item_id > 5")).count() == 6
    assert decontaminate.find_contamination(docs.where("doc_id > 9"), bench).count() == 0


def test_benchmark_windows_in_blocks_of_bounded_size(spark, monkeypatch):
    rng = random.Random(8)
    items = [(k, "a shared benchmark passage of more than ten words in every item " + sentence(rng, rng.randint(0, 30))) for k in range(20)]
    items += [(77, sentence(rng, 400)), items[3], (5, items[4][1]), (None, None), (78, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for item, text in items:
        words = decontaminate.words_of(text.encode() if text else None)
        want |= {(b" ".join(words[i:i + 10]), str(item)) for i in range(max(1, len(words) - 9) if words else 0)}
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 30)
    monkeypatch.setattr(decontaminate, "WINDOW_ROWS", 7)
    found, sizes = [], []
    for block in decontaminate.blocks(bench, 10):
        name = {k: w for w, k in block.symbols.items()}
        pairs = [(b" ".join(name[x] for x in p[10 - n:]), item)
                 for p, n, held in zip(block.patterns.tolist(), block.lengths.tolist(), block.items) for item in held]
        sizes.append(len(pairs))
        found += pairs
    assert len(found) == len(want) and set(found) == want
    assert sizes[:-1] == [30] * (len(sizes) - 1) and len(sizes) > decontaminate.CHAIN and 0 < sizes[-1] <= 30


# -- packing ------------------------------------------------------------------

BPE = P.path("word_bpe_49k.json") if hasattr(P, "path") else ""


def whole(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids


def test_word_encoder_equals_whole_texts():
    from tokenizers import Tokenizer

    rng = random.Random(8)
    bits = [*"aBÉßσΣİ '.,!é́\n\t 9x’​ﬁ漢é&/ \x85\x1c\r", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "Word", "ärger", "\x0b", " "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(4000)] + [t or "" for _, t in documents()]
    ids, sizes = packing.WordEncoder(BPE).encode(pa.array(texts))
    ends = np.append(0, np.cumsum(sizes))
    want = Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)
    assert [ids[s:e].tolist() for s, e in zip(ends, ends[1:])] == [w.ids for w in want]


def test_word_encoder_memory_is_bounded(monkeypatch):
    """Words that do not recur leave the memory, runs are cut by bytes, and the ids stay those of whole texts."""
    assert packing.MEMO_WORDS <= 100_000
    monkeypatch.setattr(packing, "MEMO_WORDS", 300)
    monkeypatch.setattr(packing, "RUN_WORDS", 7)
    monkeypatch.setattr(packing, "LOT_BYTES", 2000)
    texts = [f"the Cat{k}, " + " ".join(f"w{k}x{j}" for j in range(40)) for k in range(200)] + ["", None, "z" * 5000, ""]
    encoder, got = packing.WordEncoder(BPE), []
    column = pa.array(texts)
    cuts = list(packing.lots(column))
    assert [s for s, _ in cuts] == [0, *[e for _, e in cuts[:-1]]] and cuts[-1][1] == len(texts) and len(cuts) > 20
    for s, e in cuts:
        assert e == s + 1 or sum(len(t or "") for t in texts[s:e]) <= 2000
        ids, sizes = encoder.encode(column[s:e])
        ends = np.append(0, np.cumsum(sizes))
        got += [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
        assert len(encoder.words) < 800 and len(encoder.parts) < 800
    assert got == [whole(t) for t in texts]


def check_packing(rows, out, capacity):
    want = []
    for i, t in rows:
        ids = np.array([*whole(t), 0], "<u4")
        want += [(i, k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes())) for k, s in enumerate(range(0, len(ids), capacity))]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out]
    key = lambda t: [(x is not None, x) for x in t]
    assert sorted(got, key=key) == sorted(want, key=key)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in out) // capacity)


@pytest.mark.parametrize("group", [20_000, 12])
def test_packing_is_whole_gapless_and_tight(docs_table, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_ITEMS", group)
    rows = documents(9, 80)
    used, least = check_packing(rows, packing.pack_documents(docs_table(rows), BPE, 512).collect(), 512)
    assert used <= least * (1.03 if group > 1000 else 1.15) + 1


def test_packing_of_an_empty_table(docs_table):
    assert packing.pack_documents(docs_table([(1, "x")]).where("doc_id > 1"), BPE).count() == 0


def test_best_fit_takes_the_tightest_bin():
    where, offset, fills = packing.best_fit(np.array([5, 6, 4, 3, 2]), 10)
    assert fills.tolist() == [10, 10] and where.tolist() == [1, 0, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]


# -- token counts -------------------------------------------------------------

@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_and_their_cache(spark, docs_table, rows_of, name):
    path = P.path(name)
    cache = scratch_path(spark, "test-token-cache")
    rows = documents(10, 20) + [(6000, "a </s> <s> <|endoftext|> \x00 漢é" + " " * 5)]
    got = rows_of(token_counts.count_tokens(docs_table(rows), path, cache))
    count = token_counts.counter(path)
    key = lambda t: [(x is not None, x) for x in t]
    assert got == sorted(((i, len((t or "").encode()), count([t or ""])[0]) for i, t in rows), key=key)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in rows})  # each distinct text once
    again = token_counts.count_tokens(docs_table(rows[:10] + [(1, "a new text")]), path, cache)
    assert again.count() == 11 and spark.read.parquet(cache).count() == len({t or "" for _, t in rows}) + 1
    assert token_counts.count_tokens(docs_table(rows).where("doc_id < -5"), path, cache).count() == 0
    # what the cache holds is not encoded again
    digest = hashlib.sha256(b"never seen").digest()
    spark.createDataFrame([(bytearray(digest), bytearray(token_counts.tokenizer_digest(path)), 12345)], token_counts.CACHE).write.mode("append").parquet(cache)
    assert rows_of(token_counts.count_tokens(docs_table([(1, "never seen")]), path, cache)) == [(1, 10, 12345)]


def test_registered_token_counts_meet_the_stored_ones(spark, rows_of, tmp_path, monkeypatch):
    docs = [(1, "some text"), (2, None), (3, "some text"), (4, "more")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    cache, path = f"{tmp_path}/cache", P.path("piece_bpe_32k.model")
    monkeypatch.setattr(token_counts, "shared_path", lambda spark, name: cache)
    first = rows_of(token_counts.query(spark, str(tmp_path)))
    stored = lambda: spark.read.option("recursiveFileLookup", "true").schema(token_counts.CACHE).parquet(cache)
    assert stored().count() == 3
    # rows of another version and rows without a count change nothing, and nothing is counted twice
    key = lambda t: bytearray(hashlib.sha256(t.encode()).digest())
    now = bytearray(token_counts.tokenizer_digest(path))
    spark.createDataFrame([(key("more"), bytearray(b"old"), 99), (key("some text"), now, None)], token_counts.CACHE) \
        .write.parquet(f"{cache}/run=x")
    assert rows_of(token_counts.query(spark, str(tmp_path))) == first and stored().count() == 5


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from logweave.llm import common

    conf = {"spark.master": "spark://host:7077"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)),
                              sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="checkpoint"):
        common.scratch_path(session, "x")
    conf["spark.checkpoint.dir"] = "hdfs://shared/dir"
    assert common.scratch_path(session, "x").startswith("hdfs://shared/dir/x-")


# -- chat formatting ----------------------------------------------------------

@given(st.text(st.sampled_from("<>|[]/\\sINSTim_startendSY \n")) | st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "["])).map("".join))
@settings(max_examples=400, deadline=None)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROL)
    whole, start, end = chat.render("a\n\\" + text, text)
    assert chat.parse(whole) == ("a\n\\" + text, text) and chat.unescape(whole[start:end]) == text


def test_fold_of_deltas_edits_and_regenerations(spark, rows_of):
    log = [  # conv, seq, msg, kind, role, text
        (1, 0, 0, "start", "user", "Hi"), (1, 1, 1, "start", "assistant", "He"), (1, 2, 1, "delta", None, "llo"),
        (1, 3, 1, "regenerate", None, ""), (1, 4, 1, "delta", None, "Good "), (1, 5, 1, "delta", None, "day"),
        (1, 6, 2, "start", "user", "old"), (1, 7, 3, "start", "assistant", "gone"), (1, 8, 2, "edit", None, "new"),
        (1, 9, 3, "start", "assistant", "kept"), (2, 0, 0, "start", "user", "x"), (2, 1, 1, "start", "assistant", "y"),
        (2, 2, 0, "edit", None, "z"), (None, 0, 0, "start", None, None), (3, 5, 0, "delta", None, "b"), (3, 4, 0, "start", "user", "a"),
        (3, 6, 0, "noise", "x", "x")]
    df = spark.createDataFrame(log, "conv_id long, seq long, msg long, kind string, role string, text string").repartition(5)
    assert rows_of(chat.fold_events(df)) == [
        (None, 0, "", ""), (1, 0, "user", "Hi"), (1, 1, "assistant", "Good day"), (1, 2, "user", "new"),
        (1, 3, "assistant", "kept"), (2, 0, "user", "z"), (3, 0, "user", "ab")]
    assert chat.fold_events(df.where("conv_id > 9")).count() == 0


def test_conversations_read_back(spark, rows_of):
    rng = random.Random(11)
    convs = {c: [(t, rng.choice(["user", "assistant", "system"]), sentence(rng, rng.choice([1, 5, 300])) + rng.choice(["", "</s>", "\\"]))
                 for t in range(rng.randint(1, 8))] for c in range(30)}
    convs[77] = [(t, "assistant" if t % 2 else "user", f"say {t}") for t in range(3000)]
    convs[78] = [(0, "assistant", None), (0, "assistant", None), (0, "user", ""), (None, "user", "first")]
    rows = [(c, *m, "extra", 1) for c, ms in convs.items() for m in ms]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, msg int").repartition(4)
    got = rows_of(chat.digests(chat.format_messages(chat.fold_events(chat.conversation_events(df)))))
    want = []
    for c, ms in sorted(convs.items()):
        ms = sorted(((-1 if t is None else t, r, x or "") for t, r, x in ms))
        loss = "".join(x for _, r, x in ms if r == "assistant")
        want.append((c, len(ms), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in ms).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest()))
    assert [g[:5] for g in got] == want
    kinds = {r[0]: r[1] for r in chat.conversation_events(df).groupBy("kind").count().collect()}
    turns = {a: sum((r == "assistant") == a for ms in convs.values() for _, r, _ in ms) for a in (True, False)}
    assert kinds["regenerate"] == turns[True] and kinds["edit"] == turns[False] and kinds["start"] == turns[True] + 2 * turns[False]


# -- classifiers --------------------------------------------------------------

def judged(n=400, seed=12):
    """Documents with labels: junk by shape, toxic by a few rude words."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        junk, toxic = i % 5 == 0, i % 4 == 1
        t = sentence(rng, 60)
        if toxic:
            words = t.split()
            for _ in range(5):
                words[rng.randrange(60)] = rng.choice(["grubworm", "dunce", "vile toad"])
            t = " ".join(words)
        if junk:
            t = "!! ".join(t.upper().split()) if i % 2 else " ".join([rng.choice(WORDS)] * 60)
        rows.append((i, t))
        if i % 8 != 7:
            labels.append((i, int(not junk), int(toxic and not junk)))
    return rows, labels


@pytest.mark.parametrize("op, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_held_out_rows(spark, docs_table, op, label):
    rows, labels = judged()
    docs = docs_table(rows + [(None, None), (900, ""), (901, None), (901, None)])
    table = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (5000, 0, 0)], "doc_id long, quality int, toxic int")
    fitted = quality.fit(docs, table, quality.trainable) if op is quality else toxicity.fit(docs, table)
    got = op.score_documents(docs, fitted).select("row.doc_id", "score").collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 for r in got)
    truth = {i: q if op is quality else t for i, q, t in labels}
    hold = (lambda i: zlib.crc32(str(i).encode()) % 3 == 1) if op is quality else (lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    held = [(r.score >= 0.5) == truth[r.doc_id] for r in got if r.doc_id in truth and hold(r.doc_id)]
    assert len(held) > 40 and np.mean(held) >= 0.95
    empty = docs.where("doc_id > 10000")
    assert op.score_documents(empty, fitted).count() == 0
    fitted = quality.fit(docs, table.where("doc_id < 0"), quality.trainable) if op is quality else toxicity.fit(docs, table.where("doc_id < 0"))
    assert {r.score for r in op.score_documents(docs, fitted).select("score").collect()} == {0.5}


def evidence_of(model, text):
    _, words, sizes = next(toxicity.token_chunks(pa.table({"text": pa.array([text.encode()])}).to_batches()))
    return np.array(model.evidence(words, sizes))


def test_toxicity_counts_grow_with_the_rows(spark):
    rows = [("river stone " * 200, 0), ("river stone " * 40 + "toad " * 150, 1)]
    once = spark.createDataFrame(rows, "text string, y int").select(F.col("text").cast("binary").alias("text"), "y")
    one, many = (toxicity.Counts(df).model.value for df in (once, once.crossJoin(spark.range(1000))))
    assert many.bigram.max() >= 199_000
    text = "river stone river stone"  # a word of one class only is rightly stronger evidence if seen more often
    assert np.abs(evidence_of(one, text) - evidence_of(many, text))[:, 1:].max() < 0.05


def test_toxicity_words_share_no_counts(spark):
    words = [f"w{i}" for i in range(5000)]  # about 12 pairs of them shared one of 2^20 buckets
    rows = spark.createDataFrame([(" ".join(words).encode(), 0)], "text binary, y int")
    counts = toxicity.Counts(rows)
    assert (counts.totals["words"], counts.totals["varied"]) == (5000, 5000)
    assert len(counts.model.value.words) == 5002 and len(counts.model.value.bigrams) == 5001  # also a text's beginning, and none


def test_toxicity_scores_are_the_same_by_joins(spark, docs_table, rows_of, monkeypatch):
    rows, labels = judged(200)
    docs = docs_table(rows + [(None, None), (900, ""), (901, None), (901, None), (902, "unseen words only"), (903, rows[1][1])])
    table = spark.createDataFrame([(i, t) for i, _, t in labels], "doc_id long, toxic int")
    whole = rows_of(toxicity.score_documents(docs, toxicity.fit(docs, table)).select("row.doc_id", "score"))
    monkeypatch.setattr(toxicity, "MODEL_KEYS", 0)
    monkeypatch.setattr(toxicity, "COUNT_TOKENS", 3000)
    joined = rows_of(toxicity.score_documents(docs, toxicity.fit(docs, table)).select("row.doc_id", "score"))
    assert [r[0] for r in joined] == [r[0] for r in whole] and len(joined) == len(rows) + 6
    assert np.allclose([r[1] for r in joined], [r[1] for r in whole], atol=1e-9)


def test_toxicity_joins_write_no_texts(spark, docs_table, rows_of, monkeypatch):
    rows, labels = judged(120)
    docs = docs_table(rows + [(900, ""), (901, None), (901, None)])
    table = spark.createDataFrame([(i, t) for i, _, t in labels], "doc_id long, toxic int")
    whole = rows_of(toxicity.score_documents(docs, toxicity.fit(docs, table)).select("row.doc_id", "score"))
    kept, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (kept.append((path, self._df.columns)), write(self, path, *a, **k))[1])
    monkeypatch.setattr(toxicity, "MODEL_KEYS", 100)  # some keys are broadcast, the others are joined
    monkeypatch.setattr(toxicity, "RANGE_KEYS", 50)
    monkeypatch.setattr(toxicity, "COUNT_TOKENS", 1000)
    fitted = toxicity.fit(docs, table)
    assert len(fitted[0].hot.value[0][0]) > 5 and fitted[0].ranges.select("range").distinct().count() > 8
    joined = rows_of(toxicity.score_documents(docs, fitted).select("row.doc_id", "score"))
    assert [r[0] for r in joined] == [r[0] for r in whole] and np.allclose([r[1] for r in joined], [r[1] for r in whole], atol=1e-9)
    assert kept and not [c for _, cols in kept for c in cols if c == "text"]
    left = {os.path.basename(p).split("-")[0] for p, _ in kept if os.path.exists(p.removeprefix("file:"))}
    assert "ranges" in left and not left & {"bigrams", "words"}  # superseded tables are gone


def test_quality_filter_keeps_columns_and_clean_rows(spark, docs_table):
    rows, labels = judged()
    docs = docs_table(rows)
    out = quality.filter_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), quality.trainable)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    clean = {i for i, _ in rows if i % 5}
    assert len(clean - kept) <= 2 and len(kept - clean) <= 4


def test_labels_of_held_out_rows_change_nothing(spark, docs_table):
    rows, labels = judged(120)
    docs = docs_table(rows)
    flip = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in labels]
    a, b = (dict(map(tuple, quality.score_documents(docs, quality.fit(
        docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"), quality.trainable)).select("row.doc_id", "score").collect()))
        for x in (labels, flip))
    assert a == b


def test_registered_queries_are_whole(spark, sf_dir):
    from logweave.llm.queries import ORACLE, QUERIES

    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert QUERIES["op9_benchmark_decontamination"](spark, sf_dir).select(F.countDistinct("doc_id")).first()[0] == n
    assert json.dumps(sorted(QUERIES))


def test_pipeline_stages_keep_the_columns_of_documents(spark, sf_dir):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in cp.STAGES[:-1]:
        docs = cp.written(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] == sizes[4]
    packed = cp.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


@pytest.mark.parametrize("name", ["op6_substring_dedup", "op9_benchmark_decontamination", "op10_chat_formatting"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    import duckdb
    from logweave.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    want = con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want[got.columns].values.tolist()))
