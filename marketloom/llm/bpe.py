"""Byte-level BPE by monoid tree reduction.

Encoding is a homomorphism wherever a match of the pattern must end. With the public
pattern that is certain at every place where a non-space character is followed by a
plain space or newline: no alternative matches a white-space character after a
non-space one, and none looks further back than its own start. Such places are called
seams. A text is halved down to leaves, leaves are encoded, and two neighbours are
joined by encoding anew only the window from the last seam on the left to the first
seam on the right; all tokens outside that window are final. Where no seam is near, the
search window doubles until one is found or the whole side is in it, so a join is exact
for every text. Joining is associative, so the shape of the tree does not matter.

Defined results: null and empty texts have no tokens; the ids of a text are those that
the reference library gives for the whole text without special tokens; rows are
independent, so repeated rows repeat their answer; an empty table gives an empty result;
further columns of the input are not read and cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import table, text_or_empty

RANKS = "byte_bpe_50k.tiktoken"
LEAF_CHARS = 4096
LEAF_IDS = 8192
FIRST_WINDOW = 64
SEAM = re.compile(r"\S(?=[ \n])")
# the library's matcher overflows on white space of about a million characters; such runs are matched here (fixed values: Unicode white space)
LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{65536,}")


class Codec:
    """Encoder and decoder over one file of ranks; ``path`` names the file, ``pattern`` the public splitting rule."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.one_match = tiktoken.Encoding("one match", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.width = {rank: len(token) for token, rank in ranks.items()}

    def leaf(self, text: str) -> list[int]:
        """Ids of a text taken by itself."""
        ids, done = [], 0
        if len(text) >= 65536:
            for run in LONG_SPACE.finditer(text):
                # before other text the pattern leaves the last space of a run to the next match
                stop = run.end() if run.end() == len(text) else run.end() - 1
                ids += self.library.encode_ordinary(text[done : run.start()])
                ids += self.one_match.encode_ordinary(text[run.start() : stop])
                done = stop
        return ids + self.library.encode_ordinary(text[done:])

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, start: int, end: int) -> list[int]:
        if end - start <= LEAF_CHARS:
            return self.leaf(text[start:end])
        middle = (start + end) // 2
        return self.join(text, start, middle, end, self._encode(text, start, middle), self._encode(text, middle, end))

    def join(self, text: str, start: int, middle: int, end: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of text[start:end] from those of its two parts."""
        low, high = last_seam(text, start, middle), first_seam(text, middle, end)
        if low == high:
            left += right
            return left
        keep = len(left) - self._tokens_in(reversed(left), len(text[low:middle].encode()))
        skip = self._tokens_in(right, len(text[middle:high].encode()))
        del left[keep:]
        left += self.leaf(text[low:high])
        left += right[skip:]
        return left

    def _tokens_in(self, ids, n_bytes: int) -> int:
        """How many tokens from the near end make up the given bytes; a seam is always a token border."""
        count = 0
        for rank in ids:
            if n_bytes <= 0:
                break
            n_bytes -= self.width[rank]
            count += 1
        return count

    def decode(self, ids: list[int]) -> bytes:
        parts = [self.library.decode_bytes(ids[i : i + LEAF_IDS]) for i in range(0, len(ids), LEAF_IDS)]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


def last_seam(text: str, start: int, middle: int) -> int:
    """The last seam of text[start:middle], its end included if the next character makes it one; ``start`` if there is none."""
    window = FIRST_WINDOW
    while True:
        low = max(start, middle - window)
        found = None
        for found in SEAM.finditer(text, low, min(middle + 1, len(text))):
            pass
        if found:
            return found.end()
        if low == start:
            return start
        window *= 2


def first_seam(text: str, middle: int, end: int) -> int:
    """The first seam at or after ``middle`` inside the right part; ``end`` if there is none."""
    window = FIRST_WINDOW
    while True:
        high = min(end, middle + window)
        found = SEAM.search(text, max(middle - 1, 0), high)
        if found:
            return found.end()
        if high == end:
            return end
        window *= 2


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row: id, ``ids`` (array of token ids, if wanted), token count, digests of the ids and of the decoded bytes."""
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, "
    schema += ("ids array<int>, " if with_ids else "") + "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                kept, counts, id_marks, marks = [], [], [], []
                for text in part.column(1):
                    ids = own.encode(text.as_py())
                    if with_ids:
                        kept.append(ids)
                    counts.append(len(ids))
                    id_marks.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                    marks.append(hashlib.sha256(own.decode(ids)).hexdigest())
                columns = [part.column(0), *([pa.array(kept, pa.list_(pa.int32()))] if with_ids else [])]
                columns += [pa.array(counts, pa.int64()), pa.array(id_marks, pa.string()), pa.array(marks, pa.string())]
                names = [id_col, *(["ids"] if with_ids else []), "n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def decode_ids(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and ``data``, the bytes of its token ids (null: no bytes)."""
    schema = f"{id_col} {tokens.schema[id_col].dataType.simpleString()}, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            data = [own.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=[id_col, "data"])

    return tokens.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns over whole texts with the public 50k ranks."""
    import public_tokenizers

    return encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=False)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded."""
    return digest(table(spark, sf_dir, "documents"))
