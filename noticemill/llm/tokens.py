"""Token ids and token counts with a public word-level BPE vocabulary.

White space separates everything in this family of vocabularies: the normaliser composes characters and lower-cases, the
splitter drops white space, and BPE merges stay inside one split piece.  Two consequences carry this module:

* a position that follows white space is a *proven stable boundary*: what is left of it cannot change the ids right of it.  So
  is one between common punctuation or a digit and a letter that never composes with what precedes it, for texts without blanks;
* ids of a split piece can be remembered, so a frequent word is encoded once per worker and not once per occurrence.

Texts whose characters are all below U+0100 are split here with the vocabulary's own pattern, written out for that range, and
only the pieces go to the library's BPE model.  Everything else, and any text that may hold a special token, goes to the
library itself, one run between stable boundaries at a time.  A vocabulary file with another normaliser or splitter goes to
the library as it is, whole text by whole text.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, with_ids

#: Bound of a worker's memory of pieces; at the bound it starts afresh.
MEMO_ENTRIES = 400_000
#: Longest word that is remembered as it stands; the pieces of longer ones are.
SHORT_WORD = 10
#: Longest piece or run that is remembered, so that memory is bounded in bytes as well.
LONGEST_KEPT = 64
#: Documents of more characters are encoded in overlapping chunks.
CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 8
TOKEN_LIMIT = 2048

# The vocabulary's split pattern, for lower-cased characters below U+0100.
_LETTER = "a-zªµºß-öø-ÿ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE_LOW = "\t-\r \u0085\u00a0"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE_LOW}{_LETTER}{_NUMBER}]+")
# Unicode white space.
SPACE = f"{_SPACE_LOW}\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CONTROL_SPACE = re.compile("[\x1c-\x1f]")
_RUN = re.compile(f"[^{SPACE}]+")
# Normaliser and splitter of the vocabularies that this module knows.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_SPLITTER = {
    "type": "Split",
    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
#: Between punctuation (no apostrophe, which may begin a piece with letters) or a digit, and a letter that composes with nothing before it.
_INNER = "(?<=[0-9.,;:!?、。！，：；？])(?=[A-Za-zぁ-ゖァ-ヺ一-龥ก-ะ])"
_SURE = re.compile(_INNER)
_STABLE = re.compile(f"(?<=[{SPACE}])(?=[^{SPACE}])|{_INNER}")


def _printable_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = [""] * 256, 0x100
    for byte in range(256):
        if byte in shown:
            table[byte] = chr(byte)
        else:
            table[byte], spare = chr(spare), spare + 1
    return table


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, remembered by piece."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._model = self.tokenizer.model
        self._stand_in = _printable_bytes()
        self._special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = self._is_known(path)
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _is_known(self, path: str) -> bool:
        """Whether the vocabulary normalises and splits as this module takes for granted."""
        with open(path, encoding="utf-8") as file:
            own = json.load(file)
        parts = (own["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        plain = len(parts) == 2 and parts[1].get("type") == "ByteLevel" and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]
        merges = own["model"]["type"] == "BPE" and not own["model"].get("dropout")
        whole = not any(t["normalized"] or t["single_word"] or _STABLE.search(t["content"]) for t in own["added_tokens"])
        return own["normalizer"] == _NORMALIZER and parts[0] == _SPLITTER and plain and merges and whole

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        if (known := self.pieces.get(piece)) is None:
            if len(self.pieces) >= MEMO_ENTRIES:
                self.pieces.clear()
            ids = [t.id for t in self._model.tokenize("".join(map(self._stand_in.__getitem__, piece.encode())))]
            known = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= LONGEST_KEPT:
                self.pieces[piece] = known
        return known

    def _run(self, run: str) -> bytes:
        if (known := self.runs.get(run)) is None:
            if len(self.runs) >= MEMO_ENTRIES // 4:
                self.runs.clear()
            known = self._whole(run)
            if len(run) <= LONGEST_KEPT:
                self.runs[run] = known
        return known

    def _runs(self, text: str) -> Iterator[tuple[int, str]]:
        """Start and text of what lies between two stable boundaries."""
        for m in _RUN.finditer(text):
            at = m.start()
            for inner in _SURE.finditer(text, at + 1, m.end()):
                yield at, text[at : inner.start()]
                at = inner.start()
            yield at, text[at : m.end()]

    def _plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(s in text for s in self._special)

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            known = self._piece(word)
        else:
            known = b"".join(map(self._piece, _PIECE.findall(word)))
        if len(word) <= SHORT_WORD:  # long words are rare and would push the frequent ones out
            if len(self.words) >= MEMO_ENTRIES:
                self.words.clear()
            self.words[word] = known
        return known

    def ids(self, text: str) -> bytes:
        if not self.known:
            return self._whole(text)
        if not self._plain(text):
            return b"".join(self._run(run) for _, run in self._runs(text))
        if _CONTROL_SPACE.search(text):  # str.split() takes these for white space, the vocabulary does not
            return b"".join(map(self._piece, _PIECE.findall(text.lower())))
        found = text.lower().split()
        known = list(map(self.words.get, found))
        if None in known:
            known = [self._word(w) if k is None else k for k, w in zip(known, found, strict=True)]
        return b"".join(known)

    def spans(self, text: str) -> tuple[list[int], list[int]]:
        """Start offset and number of ids of each piece (or run between stable boundaries) of ``text``."""
        if self._plain(text):
            found = [(m.start(), self._piece(m[0])) for m in _PIECE.finditer(text.lower())]
        else:
            found = [(start, self._run(run)) for start, run in self._runs(text)]
        return [start for start, _ in found], [len(ids) >> 2 for _, ids in found]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _cut_at(text: str, begin: int, end: int) -> int:
    """A stable boundary: the last one after ``begin`` up to ``end``, else the first one behind, else the end of the text."""
    back = OVERLAP_CHARS
    while True:
        low = max(begin + 1, end - back)
        if found := [m.start() for m in _STABLE.finditer(text, low, min(end + 1, len(text)))]:
            return found[-1]
        if low == begin + 1:
            behind = _STABLE.search(text, end)
            return behind.start() if behind else len(text)
        back *= 4


def id_runs(enc: PieceEncoder, text: str, chunk: int = CHUNK_CHARS) -> Iterator[bytes]:
    """The ids of a text, some ``chunk`` characters at a time: what lies between two stable boundaries has ids of its own."""
    if not enc.known or len(text) <= chunk:
        yield enc.ids(text)
        return
    begin = 0
    while begin < len(text):
        end = begin + chunk
        end = _cut_at(text, begin, end) if end < len(text) else len(text)
        yield enc.ids(text[begin:end])
        begin = end


def spliced_count(enc: PieceEncoder, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of a long text from overlapping chunks, spliced where two neighbours agree on a stable boundary.

    The boundary is an offset in the overlap at which both chunks start a piece and that is stable by the rules above.  Where
    the overlap has none, it doubles; where the whole left chunk has none, that chunk doubles until it has, and is encoded then.
    """
    if not enc.known:
        return len(enc.ids(text)) >> 2
    total, begin, end = 0, 0, min(chunk, len(text))
    starts, counts = enc.spans(text[begin:end])
    while end < len(text):
        back, at = min(overlap, end - begin - 1), None
        while True:
            right = end - back
            if _STABLE.search(text, right + 1, end):
                next_end = min(end + chunk, len(text))
                r_starts, r_counts = enc.spans(text[right:next_end])
                left = {begin + s for s in starts if begin + s > right}
                at = next((right + s for s in reversed(r_starts) if right + s in left and _STABLE.match(text, right + s)), None)
            if at is not None or back >= end - begin - 1:
                break
            back = min(2 * back, end - begin - 1)
        if at is None:
            size = end - begin
            while end < len(text):
                size *= 2
                end = min(begin + size, len(text))
                if _STABLE.search(text, begin + 2, end):
                    break
            starts, counts = enc.spans(text[begin:end])
            continue
        total += sum(n for s, n in zip(starts, counts, strict=True) if begin + s < at)
        kept = [(s + right - at, n) for s, n in zip(r_starts, r_counts, strict=True) if right + s >= at]
        begin, end = at, next_end
        starts, counts = [s for s, _ in kept], [n for _, n in kept]
    return total + sum(counts)


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = TOKEN_LIMIT,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Bytes and tokens of every whole text; one row for each row of ``docs``, no shuffle.

    Null and empty texts have 0 bytes and 0 tokens.  Null ids stay null.  Repeated rows give repeated results, an empty table
    gives an empty one, and other columns of ``docs``, whatever their names, are not read.  A text of more than ``chunk``
    characters is encoded chunk by chunk, so that memory follows the chunk and not the document.

    ``path`` is the vocabulary file; it must exist under that name on every worker.
    """

    bounded_batches(docs.sparkSession)

    def counted(pdf: pd.DataFrame) -> tuple[None, pd.DataFrame]:
        enc = encoder(path)
        n = [len(enc.ids(t)) >> 2 if len(t) <= chunk else spliced_count(enc, t, chunk, overlap) for t in pdf["text"]]
        return None, pd.DataFrame({"n_tokens": n})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return with_ids(batches, counted, ["doc_id", "n_bytes"], pa.schema([("n_tokens", pa.int64())]))

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
