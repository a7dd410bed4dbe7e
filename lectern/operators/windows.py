"""Token windows over contexts: reader features, fixed chunks and chunks cut at
separators. Everything is computed inside the row of its passage and leaves by
one explode, so no window shuffles."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.text import SpannedTokenizer, attention_mask, cased_tokens, pad, token_spans
from lectern.operators.sizing import spread

MAX_LENGTH = 384
DOC_STRIDE = 128
MARKERS = 3  # [CLS] question [SEP] context [SEP]
# Separators tried in turn, from a blank line down to characters.
SEPARATORS = ("\n\n", "\n", " ", "")


def window_starts(n: Column, capacity: Column, overlap: Column | int) -> Column:
    """First token of each window. Neighbours share ``overlap`` tokens."""
    step = capacity - overlap
    last = F.when(n <= capacity, F.lit(0)).otherwise(F.ceil((n - capacity) / step).cast("int") * step)
    return F.sequence(F.lit(0), last.cast("int"), step.cast("int"))


def _tokens(text: str, reader: SpannedTokenizer | None) -> Column:
    """Tokens of a column, or of a column of the pieces that ``reader`` made."""
    return cased_tokens(F.col(text)) if reader is None else F.transform(text, lambda p: p["t"])


def _read(df: DataFrame, reader: SpannedTokenizer | None, *texts: str) -> DataFrame:
    """``df`` with texts replaced by the pieces of ``reader``, so that a text is read once."""
    return df if reader is None else df.withColumns({c: reader(F.col(c)) for c in texts})


def features(
    examples: DataFrame, max_length: int = MAX_LENGTH, stride: int = DOC_STRIDE, reader: SpannedTokenizer | None = None
) -> DataFrame:
    """Windows of ``examples`` (id, question, context, ...).

    Every window holds the whole question. Where it leaves no more room than two neighbours share,
    they share one token less than there is room, so that windows still go forward. Questions that
    leave no room have no window; ``rejected_questions`` lists them. Adds window_no, feature_id, tokens
    (markers and question included) and offsets, null outside the context. Other columns are carried along.
    Tokens are words, or the pieces of a ``reader`` as :func:`lectern.functions.text.subwords` makes."""
    carried = [c for c in examples.columns if c not in ("question", "context")]
    spans = token_spans(F.col("context")) if reader is None else F.transform("context", lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e")))
    read = _read(examples, reader, "question", "context").select(
        *carried,
        _tokens("question", reader).alias("_q"),
        _tokens("context", reader).alias("_t"),
        spans.alias("_o"),
    ).withColumn("_cap", F.lit(max_length) - F.size("_q") - MARKERS)
    overlap = F.least(F.lit(stride), F.col("_cap") - 1)
    starts = F.when(F.col("_cap") >= 1, window_starts(F.size("_t"), F.col("_cap"), overlap))
    placed = read.select(
        *carried, "_q", "_t", "_o", "_cap", F.posexplode(starts).alias("window_no", "_first")
    )
    begin = F.col("_first") + 1
    tokens = F.concat(
        F.array(F.lit("[CLS]")), F.col("_q"), F.array(F.lit("[SEP]")),
        F.slice("_t", begin, F.col("_cap")), F.array(F.lit("[SEP]")),
    )
    outside = F.lit(None).cast("struct<s:int,e:int>")
    offsets = F.concat(
        F.array_repeat(outside, F.size("_q") + 2), F.slice("_o", begin, F.col("_cap")), F.array(outside)
    )
    return placed.select(
        *carried,
        "window_no",
        F.concat_ws("-", "id", "window_no").alias("feature_id"),
        tokens.alias("tokens"),
        offsets.alias("offsets"),
    )


def rejected_questions(examples: DataFrame, max_length: int = MAX_LENGTH, reader: SpannedTokenizer | None = None) -> DataFrame:
    """(id, question_tokens, most_tokens) of the examples that ``features`` makes no window of, as
    their question leaves no room for a token of the context."""
    most = max_length - MARKERS - 1
    counted = _read(examples, reader, "question").select("id", F.size(_tokens("question", reader)).alias("question_tokens"))
    return counted.filter(F.col("question_tokens") > most).withColumn("most_tokens", F.lit(most))


def with_padding(features: DataFrame, width: Column | int = MAX_LENGTH) -> DataFrame:
    return features.select(
        *[c for c in features.columns if c != "tokens"],
        pad(F.col("tokens"), width).alias("tokens"),
        attention_mask(F.col("tokens"), width).alias("attention_mask"),
    )


def label_answers(features: DataFrame, answers: str = "answers") -> DataFrame:
    """Add start_position and end_position of the first answer, or 0 and 0 where
    the window does not hold all of it."""
    start_char = F.get(F.col(answers)["answer_start"], 0)
    end_char = start_char + F.length(F.get(F.col(answers)["text"], 0))
    spots = F.filter(
        F.transform("offsets", lambda o, i: F.struct(i.alias("i"), o["s"].alias("s"), o["e"].alias("e"))),
        lambda t: t["s"].isNotNull(),
    )
    bound = features.withColumn("_spots", spots).withColumn("_from", start_char).withColumn("_to", end_char)
    first, last = F.get("_spots", 0), F.element_at("_spots", -1)
    holds = (
        (F.size("_spots") > 0) & F.col("_from").isNotNull()
        & (first["s"] <= F.col("_from")) & (last["e"] >= F.col("_to"))
    )
    start = F.array_max(F.transform(F.filter("_spots", lambda t: t["s"] <= F.col("_from")), lambda t: t["i"]))
    end = F.array_min(F.transform(F.filter("_spots", lambda t: t["e"] >= F.col("_to")), lambda t: t["i"]))
    return (
        bound.withColumn("start_position", F.when(holds, start).otherwise(0))
        .withColumn("end_position", F.when(holds, end).otherwise(0))
        .drop("_spots", "_from", "_to")
    )


def fixed_chunks(passages: DataFrame, size: int = 300, overlap: int = 50, reader: SpannedTokenizer | None = None) -> DataFrame:
    """(pid, chunk_no, tokens), with a ``reader`` of pieces (pid, chunk_no, tokens, text). ``text`` is what the pieces
    cover; a character that its first piece shares with the piece before is that one's."""
    if reader is None:
        read = passages.select("pid", cased_tokens(F.col("text")).alias("_t"))
        return read.select(
            "pid", "_t", F.posexplode(window_starts(F.size("_t"), F.lit(size), overlap)).alias("chunk_no", "_first")
        ).select("pid", "chunk_no", F.slice("_t", F.col("_first") + 1, size).alias("tokens"))
    read = passages.select("pid", "text", F.col("text").alias("_t")).withColumn("_t", reader(F.col("_t")))
    starts = window_starts(F.size("_t"), F.lit(size), overlap)
    placed = read.select("pid", "text", "_t", F.posexplode(starts).alias("chunk_no", "_first"))
    own = placed.withColumns(
        {"_own": F.slice("_t", F.col("_first") + 1, size), "_before": F.coalesce(F.get("_t", F.col("_first") - 1)["e"], F.lit(0))}
    )
    begin = F.greatest(F.get("_own", 0)["s"], F.col("_before"))
    end = F.get("_own", F.size("_own") - 1)["e"]
    covered = F.coalesce(F.substring("text", begin + 1, end - begin), F.lit(""))
    return own.select("pid", "chunk_no", F.transform("_own", lambda p: p["t"]).alias("tokens"), covered.alias("text"))


# -- recursive chunks -----------------------------------------------------

def _pieces(text: str, separator: str) -> list[str]:
    """Parts of ``text``; each but the first keeps the separator in front of it."""
    if not separator:
        return list(text)
    first, *rest = text.split(separator)
    return ([first] if first else []) + [separator + part for part in rest]


def _merge(pieces: list[str], size: int, overlap: int, length: Callable[[str], int]) -> Iterator[str]:
    """Fill chunks greedily up to ``size``; each starts with as many of the last
    pieces of the one before as fit into ``overlap``."""
    held: deque[tuple[str, int]] = deque()
    total = 0
    for piece in pieces:
        n = length(piece)
        if held and total + n > size:
            yield "".join(p for p, _ in held)
            while held and (total > overlap or total + n > size):
                total -= held.popleft()[1]
        total += n
        held.append((piece, n))
    if held:
        yield "".join(p for p, _ in held)


def split_recursively(
    text: str, size: int, overlap: int, length: Callable[[str], int], separators: tuple[str, ...] = SEPARATORS
) -> list[str]:
    """Chunks of one text. A piece that is too long is cut at the next finer
    separator."""
    at = next(i for i, s in enumerate(separators) if s == "" or s in text)
    separator, finer = separators[at], separators[at + 1 :]
    chunks: list[str] = []
    short: list[str] = []
    for piece in _pieces(text, separator):
        if length(piece) < size:
            short.append(piece)
            continue
        chunks.extend(_merge(short, size, overlap, length))
        short = []
        chunks.extend(split_recursively(piece, size, overlap, length, finer) if finer else [piece])
    chunks.extend(_merge(short, size, overlap, length))
    return [c.strip() for c in chunks if c.strip()]


def recursive_chunks(
    passages: DataFrame, size: int = 300, overlap: int = 50, length: Callable[[str], int] = len
) -> DataFrame:
    """(pid, chunk_no, text). ``length`` measures a string, for instance a
    subword tokenizer's count; by default its characters. The passages are spread
    first, as a scan may hold many long texts in one task."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pids, numbers, texts = [], [], []
            for pid, text in zip(batch["pid"].to_pylist(), batch["text"].to_pylist()):
                for number, piece in enumerate(split_recursively(text or "", size, overlap, length)):
                    pids.append(pid)
                    numbers.append(number)
                    texts.append(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(texts, pa.string())],
                names=["pid", "chunk_no", "text"],
            )

    texts = spread(passages.select(F.col("pid").cast("long").alias("pid"), "text"), "pid")
    return texts.mapInArrow(chunk, "pid long, chunk_no int, text string")
