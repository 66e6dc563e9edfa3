"""Chat formatting from an event log.

Logs are partitioned by conversation and sorted by sequence. An edit or a
regeneration cuts a conversation: what its message held before and all later
messages fall away. A running minimum over the log, backwards, tells which
events outlive all later cuts; what is left of a message (its start, streamed
deltas, edits) is folded in order. Each message renders by itself, so no
conversation is ever held whole, however long it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that some template or tokenizer reads as control: they are never left whole in a text.
CONTROL = [START, END, "<|startoftext|>", "<|endoftext|>", "<s>", "</s>", "<unk>", "<pad>",
           "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ANY = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
#: Code points of one streamed delta, and of a superseded draft, in the registered query.
DELTA_CHARS = 400


def escape(text: str) -> str:
    """Break every control string by a backslash after its first character (one more where there are some already)."""
    return _ANY.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ANY.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered message and the span of its text (code points)."""
    head = START + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a rendered message."""
    if not (formatted.startswith(START) and formatted.endswith(END + "\n")):
        raise ValueError("not a rendered message")
    role, _, body = formatted[len(START):-len(END) - 1].partition("\n")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))
    return role, unescape(body)


def fold_events(events: DataFrame) -> DataFrame:
    """``(conv_id, msg, role, text)``: the final messages of a log ``(conv_id, seq, msg, kind, role, text)``.

    Kinds: ``start`` and ``delta`` add text to message ``msg``; ``edit``
    replaces its text and ``regenerate`` empties it (its text, if any, is the
    beginning of the new one), and both drop all later messages. The last
    role given to a message holds. Events of equal ``seq`` count in the order
    of msg, kind, role and text; null texts and roles are empty, a null
    ``seq`` or ``msg`` sorts first, events of other kinds are ignored. A null
    ``conv_id`` is a conversation of its own. Other columns are ignored.
    """
    order = [F.struct("seq", "msg", "kind", "role", "text").alias("at")]
    log = events.select("conv_id", "seq", "msg", "kind", "role", F.coalesce("text", F.lit("")).alias("text"), *order) \
        .where(F.col("kind").isin("start", "delta", "edit", "regenerate"))
    cut = F.when(F.col("kind").isin("edit", "regenerate"), F.coalesce("msg", F.lit(-(1 << 62))))
    later = Window.partitionBy("conv_id").orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, -1)
    log = log.withColumn("cut", F.min(cut).over(later))
    alive = F.col("cut").isNull() | (F.coalesce("msg", F.lit(-(1 << 62))) < F.col("cut"))
    parts = F.array_sort(F.collect_list(F.when(alive, F.struct("at", "text"))))
    return (log.groupBy("conv_id", "msg")
            .agg(F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at"))).alias("role"), parts.alias("parts"))
            .where(F.size("parts") > 0)
            .select("conv_id", "msg", F.coalesce("role", F.lit("")).alias("role"),
                    F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")))


def format_messages(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, msg, formatted, loss_start, loss_end)``: one rendered segment per message.

    A conversation's text is its segments in the order of ``msg``. The loss
    span (code points of the segment, null for other roles) covers the
    escaped text of ``loss_role`` messages and nothing else.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(*render(r or "", t or ""), r == loss_role)
                    for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("msg"), pa.array([x[0] for x in rows], pa.string()),
                 pa.array([x[1] if x[3] else None for x in rows], pa.int64()),
                 pa.array([x[2] if x[3] else None for x in rows], pa.int64())],
                ["conv_id", "msg", "formatted", "loss_start", "loss_end"])
    return messages.select("conv_id", "msg", "role", "text").mapInArrow(
        run, "conv_id long, msg long, formatted string, loss_start long, loss_end long")


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the rendered conversations back gives, one row per conversation, streamed segment by segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def row():
            cols = [now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]]
            return [pa.array([v], t) for v, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]

        out = []
        for b in batches:
            for conv, text, start, end in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(row())
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = parse(text)
                now[1] += 1
                now[2].update(f"{role}\n{said}\n".encode())
                if start is not None:
                    loss = unescape(text[start:end])
                    now[3] += len(loss)
                    now[4].update(loss.encode())
                now[5] += len(text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*out)], DIGESTS_NAMES)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_arrays(row(), DIGESTS_NAMES)
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "msg").mapInArrow(run, DIGESTS)


DIGESTS_NAMES = [x.split()[0] for x in DIGESTS.split(", ")]


def conversation_events(rows: DataFrame) -> DataFrame:
    """An event log, from finished turns, that folds to them again.

    An assistant's message is a streamed draft, then a regeneration whose
    deltas are its text. Any other message is sent as a draft and answered;
    then an edit replaces it by its text, and the answer falls away. Drafts
    are the text's first words turned around, so none may outlive its cut.
    Rows of one conversation are messages in the order of turn, role and
    text; repeated rows are messages each.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    msgs = rows.select("conv_id", "role", text.alias("text"), (F.row_number().over(order) - 1).cast("long").alias("msg"))
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("text") - 1) / DELTA_CHARS).cast("int"))),
                         lambda i: F.substring(F.col("text"), i * DELTA_CHARS + 1, F.lit(DELTA_CHARS)))
    pieces = F.when(F.col("role") == "assistant", pieces).otherwise(F.array("text"))
    streamed = F.coalesce(F.col("role") == "assistant", F.lit(False))
    draft = F.concat(F.lit("draft "), F.reverse(F.substring("text", 1, DELTA_CHARS)))

    def event(msg, kind, role, said):
        return F.struct(msg.alias("msg"), kind.alias("kind"), role.cast("string").alias("role"), said.alias("text"))

    msg, role, none = F.col("msg"), F.col("role"), F.lit(None)
    before = F.array(event(msg, F.lit("start"), role, draft),
                     # the draft goes on, or is answered by a message that the edit drops
                     event(F.when(streamed, msg).otherwise(msg + 1), F.when(streamed, "delta").otherwise("start"), none, draft))
    final = F.transform(pieces, lambda p, k: event(
        msg, F.when(k > 0, "delta").when(streamed, "regenerate").otherwise("edit"), F.when(k == 0, role), p))
    events = msgs.select("conv_id", msg.alias("turn"), F.posexplode(F.concat(before, final)).alias("k", "event"))
    return events.select("conv_id", (F.col("turn") * (1 << 32) + F.col("k")).alias("seq"), "event.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: every conversation folded from its log, rendered, and read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return digests(format_messages(fold_events(conversation_events(rows.unionByName(extra)))))
