"""Text column functions. All stay inside the JVM except :func:`nfkc` and
:func:`token_spans`, which have no built-in and run as Arrow batches."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

Tokenizer = Callable[[Column], Column]

# The ASCII punctuation marks that answer normalisation deletes.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Characters rewritten to ', < and >.
QUOTE_CHARS = "“”‘’"
OPEN_BRACKET_CHARS = "〈<＜「≪《『"
CLOSE_BRACKET_CHARS = "〉>＞」≫》』"
# Deleted characters and, as a pattern, deleted sequences
# (backslash + n, pipe + hash).
DELETED_CHARS = "*\n"
DELETED_SEQUENCES = r"\\n|\|#"
# Substrings removed from prompts, in this order.
PROMPT_NOISE = ("\\n", "\n", "\\", "context", ":", ".", '"')
# Whitespace as Python's str methods see it.
PY_SPACE = r"[\s\x1c-\x1f]"

SPAN = StructType([StructField("s", IntegerType()), StructField("e", IntegerType())])


# -- tokens ---------------------------------------------------------------

def whitespace_tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens without empties (the default tokenizer)."""
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def cased_tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, r"\s+"), "")


def space_tokens(text: Column) -> Column:
    """Exact split on one space: runs of spaces leave empty tokens."""
    return F.split(text, " ")


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs joined by a space."""
    width = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), width),
        F.slice(tokens, F.lit(2), width),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def unigrams_and_bigrams(tokens: Column) -> Column:
    return F.concat(tokens, bigrams(tokens))


def truncate(tokens: Column, limit: int) -> Column:
    return F.slice(tokens, 1, limit)


def pad(tokens: Column, width: Column | int, pad_token: str = "[PAD]") -> Column:
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(tokens, F.array_repeat(F.lit(pad_token), (width - F.size(tokens)).cast("int")))


def attention_mask(tokens: Column, width: Column | int) -> Column:
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(
        F.array_repeat(F.lit(1), F.size(tokens)),
        F.array_repeat(F.lit(0), (width - F.size(tokens)).cast("int")),
    )


@F.arrow_udf(ArrayType(SPAN))
def token_spans(text: pa.Array) -> pa.Array:
    """(start, end) code-point pair of every whitespace token."""
    word = re.compile(r"[^ \t\n\r\f\v]+")
    starts, ends, lengths = [], [], []
    for value in text.to_pylist():
        before = len(starts)
        if value is not None:
            for m in word.finditer(value):
                starts.append(m.start())
                ends.append(m.end())
        lengths.append(len(starts) - before)
    offsets = [0]
    for n in lengths:
        offsets.append(offsets[-1] + n)
    spans = pa.StructArray.from_arrays(
        [pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["s", "e"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)


PIECE = ArrayType(StructType([StructField("t", StringType()), StructField("id", IntegerType()), *SPAN.fields]))
SpannedTokenizer = Callable[[Column], Column]
PIECE_TEXTS = 64  # texts whose pieces are held at a time
_tokenizers: dict = {}


def _pieces(tokenizer, texts: pa.Array) -> pa.Array:
    """The pieces of some texts, as columns of the numbers and strings of all of them."""
    names, numbers, sizes = [], [], []
    for value in texts.to_pylist():
        read = None if value is None else tokenizer.encode(value, add_special_tokens=False)
        sizes.append(None if read is None else len(read.ids))
        if sizes[-1]:
            names.append(pa.array(read.tokens, pa.string()))
            numbers.append(np.column_stack([np.asarray(read.ids, np.int32), np.asarray(read.offsets, np.int32)]))
    at = np.cumsum([0, *(n or 0 for n in sizes)]).tolist()
    i, s, e = (np.ascontiguousarray(c) for c in np.concatenate([np.zeros((0, 3), np.int32), *numbers]).T)
    fields = [pa.concat_arrays([pa.array([], pa.string()), *names]), pa.array(i), pa.array(s), pa.array(e)]
    # an offset that is null marks a text that is
    starts = pa.array([*(None if n is None else x for n, x in zip(sizes, at)), at[-1]], pa.int32())
    return pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays(fields, names=["t", "id", "s", "e"]))


def subwords(path: str) -> SpannedTokenizer:
    """Pieces (t, id, s, e) by the tokenizer of a JSON file that all executors see: text and id of every piece and the
    code points it covers. Pieces inside one character cover it together. Markers of the file are ordinary text."""

    @F.arrow_udf(PIECE)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if path not in _tokenizers:  # once per Python worker
            from tokenizers import Tokenizer

            _tokenizers[path] = Tokenizer.from_file(path)
            _tokenizers[path].encode_special_tokens = True
        for texts in batches:
            for i in range(0, len(texts), PIECE_TEXTS):
                yield _pieces(_tokenizers[path], texts[i : i + PIECE_TEXTS])

    return pieces


# -- cleaning -------------------------------------------------------------

STABLE_RUNS = 24


@lru_cache(maxsize=None)
def unstable_class() -> str:
    """A regular expression class of all characters but the longest runs of those that NFKC never changes,
    wherever they stand: normal by themselves, not combining, and never the second half of a composed one."""
    seconds = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}  # Hangul vowels and finals, composed by rule
    for c in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(chr(int(parts[1], 16)))

    def stable(c: int) -> bool:
        x = chr(c)
        return not 0xD800 <= c < 0xE000 and not unicodedata.combining(x) and x not in seconds and unicodedata.is_normalized("NFKC", x)

    runs, start = [], None
    for c in range(sys.maxunicode + 2):
        if c <= sys.maxunicode and stable(c):
            start = c if start is None else start
        elif start is not None:
            runs.append((start, c - 1))
            start = None
    longest = sorted(sorted(runs, key=lambda r: r[0] - r[1])[:STABLE_RUNS] + [r for r in runs if r[0] < 0x180])
    return "[^" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in dict.fromkeys(longest)) + "]"


@F.arrow_udf(StringType())
def _nfkc(text: pa.Array) -> pa.Array:
    return pa.array(
        [None if v is None else unicodedata.normalize("NFKC", v) for v in text.to_pylist()],
        pa.string(),
    )


def nfkc(text: Column | str) -> Column:
    """NFKC of a string. A check in the JVM keeps texts that it cannot change; the others go through Python."""
    text = F.col(text) if isinstance(text, str) else text
    asked = F.regexp_like(text, F.lit(unstable_class()))
    return F.when(asked, _nfkc(F.when(asked, text))).otherwise(text)


@F.arrow_udf(ArrayType(StringType()))
def nfkc_all(texts: pa.Array) -> pa.Array:
    """NFKC of every string of an array column."""
    return pa.array(
        [None if row is None else [None if v is None else unicodedata.normalize("NFKC", v) for v in row] for row in texts.to_pylist()],
        pa.list_(pa.string()),
    )


def fold_full_width(text: Column) -> Column:
    """The full-width ASCII block and the ideographic space, JVM-side. Equal to
    NFKC on text that has no other compatibility characters."""
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000"
    narrow = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
    return F.translate(text, wide, narrow)


def rewrite_special(text: Column) -> Column:
    """Unify quotes and brackets, and delete layout leftovers.

    Only texts that hold a deleted sequence meet the pattern. What it leaves and
    the single characters go through one translation; it may delete characters
    last because no sequence contains one."""
    has_sequence = F.contains(text, F.lit("\\n")) | F.contains(text, F.lit("|#"))
    out = F.when(has_sequence, F.regexp_replace(text, DELETED_SEQUENCES, "")).otherwise(text)
    unified = "'" * len(QUOTE_CHARS) + "<" * len(OPEN_BRACKET_CHARS) + ">" * len(CLOSE_BRACKET_CHARS)
    return F.translate(out, QUOTE_CHARS + OPEN_BRACKET_CHARS + CLOSE_BRACKET_CHARS + DELETED_CHARS, unified)


def remap_offset(text: Column, start: Column, clean: Callable[[Column], Column]) -> Column:
    """Where code-point offset ``start`` of ``text`` lands after ``clean``."""
    return F.length(clean(F.substring(text, F.lit(1), start)))


def strip(text: Column) -> Column:
    """Trim all leading and trailing whitespace, not only spaces."""
    return F.regexp_replace(text, f"(?U)^{PY_SPACE}+|{PY_SPACE}+\\z", "")


def clean_prompt(text: Column) -> Column:
    out = text
    for noise in PROMPT_NOISE:
        out = F.replace(out, F.lit(noise), F.lit(""))
    return strip(out)


def prompt(question: Column, context: Column) -> Column:
    return F.concat(
        F.lit("question: "), clean_prompt(question), F.lit("  context: "), clean_prompt(context), F.lit(" </s>")
    )


def target(answer: Column) -> Column:
    return F.concat(clean_prompt(answer), F.lit(" </s>"))


def decoder_input(answer: Column) -> Column:
    return F.concat(F.lit("<s>"), answer, F.lit("</s>"))


def decoder_label(answer: Column) -> Column:
    return F.concat(answer, F.lit("</s>"))


# -- answer normalisation -------------------------------------------------

def answer_tokens(text: Column) -> Column:
    """Tokens of a normalised answer: lower case, no ASCII punctuation, no
    English articles. The word boundary is spelled out because ``\\b`` does not
    treat combining marks the same in Java and in Python."""
    out = F.translate(F.lower(text), ASCII_PUNCTUATION, "")
    out = F.regexp_replace(out, r"(?<![\p{L}\p{N}])(?:a|an|the)(?![\p{L}\p{N}])", " ")
    return F.array_remove(F.split(out, f"(?U){PY_SPACE}+"), "")


def normalize_answer(text: Column) -> Column:
    return F.array_join(answer_tokens(text), " ")
