"""Byte-level BPE by recursive DuckDB queries inside each partition."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.common import require, table, with_columns

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Bounds on what a task holds at once; results don't depend on them.
BLOCK_WORDS = 100_000
BLOCK_TOKENS = 250_000
KNOWN_WORDS = 150_000
BYTES_PER_RECURSION = 250_000
SHORT_BYTES = 200
ROWS_PER_RECURSION = 500_000

# White space spelt out: Python's \s has four more control characters than other libraries.
_PATTERN = public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(
    r"(?!\S)", r"(?!\P{White_Space})"
).replace(r"\s+", r"\p{White_Space}+")

_SETTINGS = "SET threads = 1; SET memory_limit = '150MB'; SET temp_directory = ''"

# A row is a token of a word with its successor (-1 at the end of the word). Each step finds a
# word's leftmost pair of least rank, gives the merged token to both neighbours and takes the
# pair's row out; a word without such a pair leaves the recursion.
_SHORT = """
WITH RECURSIVE run(w, pos, after, tok, succ, live) AS (
    SELECT w, pos, after, tok, succ, true FROM words
    UNION ALL
    SELECT w, CASE WHEN pos = second THEN first ELSE pos END, after,
           CASE WHEN pos = second THEN merged ELSE tok END,
           CASE WHEN after = first THEN merged ELSE succ END, merged IS NOT NULL
    FROM (
        SELECT run.*, best >> 40 AS merged, (best >> 20) & 1048575 AS first,
               best & 1048575 AS second
        FROM run LEFT JOIN (
            SELECT w, min((merged::BIGINT << 40) + (pos << 20) + after) AS best
            FROM run JOIN merges ON merges.pair = tok * 65536 + succ
            WHERE live GROUP BY w
        ) USING (w) WHERE live
    ) WHERE merged IS NULL OR pos <> first
)
SELECT w, list(tok::INTEGER ORDER BY pos) AS ids FROM run WHERE NOT live GROUP BY w ORDER BY w
"""

# Long words: as above, but a step contracts every non-overlapping pair of least rank, from the
# left, where no pair that this makes can have a lesser rank. The depth bounds the rows.
_LONG = """
WITH RECURSIVE run(w, pos, tok, depth, live) AS (
    SELECT w, pos, tok, 0, true FROM words
    UNION ALL
    SELECT w, pos, CASE WHEN chosen THEN merged ELSE tok END, depth + 1, best IS NOT NULL
    FROM (
        SELECT *, lag(chosen, 1, false) OVER (PARTITION BY w ORDER BY pos) AS gone
        FROM (
            SELECT *, coalesce(merged = best AND CASE WHEN safe
                   THEN (place - min(place) OVER (PARTITION BY w, island, merged = best)) % 2 = 0
                   ELSE place = min(place) OVER (PARTITION BY w, merged = best) END, false) AS chosen
            FROM (
                SELECT *, place - row_number() OVER (PARTITION BY w, merged = best ORDER BY pos)
                       AS island
                FROM (
                    SELECT pairs.*, merged, safe, min(merged) OVER (PARTITION BY w) AS best
                    FROM (
                        SELECT *, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS succ,
                               row_number() OVER (PARTITION BY w ORDER BY pos) AS place
                        FROM run WHERE live AND depth < $depth
                    ) AS pairs LEFT JOIN merges ON merges.pair = tok * 65536 + succ
                )
            )
        )
    ) WHERE NOT gone
)
SELECT w, pos, tok, live FROM run WHERE NOT live OR depth = $depth
"""

# A row has so many neighbouring tokens of a document: ordering rows costs more than reading them.
TOKENS_PER_ROW = 8

# The vocabulary is one list; an id that it lacks stands for nothing.
_DECODE = f"""
SELECT doc, string_agg(concat({", ".join(f"chars[t{i} + 1]" for i in range(TOKENS_PER_ROW))}), ''
                       ORDER BY place) AS chars
FROM tokens, vocabulary GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=1)
def _merge_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the single bytes; pairs, what they merge to, and whether nothing lesser can arise.

    About a megabyte, kept by a worker for its later tasks.
    """
    ranks = read_ranks(path)
    merges = np.array(
        [
            (ranks[token[:i]] * 65536 + ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
    )
    pair, merged = merges[:, 0], merges[:, 1]
    part_is_later = (pair >> 16 > merged, pair & 65535 > merged)
    unsafe = np.concatenate([pair[part_is_later[0]] >> 16, pair[part_is_later[1]] & 65535])
    single = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
    return single, pair, merged, ~np.isin(merged, unsafe)


def _database(table: str, columns: dict[str, pa.Array]) -> duckdb.DuckDBPyConnection:
    """A database of this process with one table."""
    database = duckdb.connect()
    database.execute(_SETTINGS)
    given = pa.table(columns)  # noqa: F841  DuckDB finds tables by the names of local variables
    database.execute(f"CREATE TABLE {table} AS SELECT * FROM given")
    return database


class PairEncoder:
    """Encodes texts by the ranks of a vocabulary file."""

    def __init__(self, path: str = VOCABULARY) -> None:
        self._bytes, pair, merged, safe = _merge_table(path)
        self._pattern = regex.compile(_PATTERN)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._db = _database("merges", {"pair": pair, "merged": merged, "safe": safe})

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        parts = []
        for words in self._words(text or ""):
            self._prepare(set(words))
            parts.append(b"".join(map(self._known.__getitem__, words)))
        return b"".join(parts)

    def _prepare(self, used: set[str]) -> None:
        """Have all these words known, worked out if they are not among those remembered.

        Words are remembered in two generations. When the newer one is full it becomes the older
        one, and words that are used again come over: what is common stays known for good.
        """
        new = used.difference(self._known)
        if len(new) + len(self._known) > KNOWN_WORDS:
            self._older, self._known = self._known, {}
            new = used
        again = {word for word in new if word in self._older}
        self._known.update((word, self._older[word]) for word in again)
        self._learn(new.difference(again))

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """As ``encode``, with one recursion for the new words of many texts."""
        block: list[list[str]] = []
        n = 0
        for text in texts:
            text = text or ""
            if len(text) > BLOCK_WORDS:
                yield from self._block(block)
                block, n = [], 0
                yield self.encode(text)
                continue
            block.append(self._pattern.findall(text))
            n += len(block[-1])
            if n >= BLOCK_WORDS:
                yield from self._block(block)
                block, n = [], 0
        yield from self._block(block)

    def _block(self, block: list[list[str]]) -> Iterator[bytes]:
        self._prepare(set().union(*block))
        for words in block:
            yield b"".join(map(self._known.__getitem__, words))

    def _words(self, text: str) -> Iterator[list[str]]:
        found = (match.group() for match in self._pattern.finditer(text))
        while words := list(islice(found, BLOCK_WORDS)):
            yield words

    def _learn(self, new: Iterable[str]) -> None:
        short, long = [], []
        for word in new:
            raw = word.encode("utf-8", "replace")
            (short if len(raw) <= SHORT_BYTES else long).append((word, raw))
        # Every recursion first reads all merges, so it takes as many words as it can hold.
        ends = np.cumsum([len(raw) for _, raw in short])
        parts = np.unique(ends // BYTES_PER_RECURSION, return_index=True)[1].tolist()
        for start, end in zip(parts, [*parts[1:], len(short)]):
            part = short[start:end]
            self._remember(part, self._short(part))
        for word, raw in long:
            self._known[word] = self._long(raw).astype("<u4").tobytes()

    def _short(self, new: list[tuple[str, bytes]]) -> pa.Table:
        words = self._rows([raw for _, raw in new])  # noqa: F841
        return self._db.sql(_SHORT).to_arrow_table()

    def _remember(self, new: list[tuple[str, bytes]], found: pa.Table) -> None:
        ids = found["ids"].combine_chunks()
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        ends = (ids.offsets.to_numpy(zero_copy_only=False).astype(np.int64) * 4).tolist()
        for (word, _), start, end in zip(new, ends, ends[1:]):
            self._known[word] = flat[start:end]

    def _rows(self, raw: list[bytes]) -> pa.Table:
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        after = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        tokens = self._bytes[flat]
        succ = np.append(tokens[1:], -1)
        succ[after - 1] = -1
        pos = np.arange(len(flat)) - np.repeat(after - sizes, sizes)
        w = np.repeat(np.arange(len(raw), dtype=np.int32), sizes)
        return pa.table({"w": w, "pos": pos, "after": pos + 1, "tok": tokens, "succ": succ})

    def _long(self, raw: bytes) -> np.ndarray:
        rows = self._rows([raw])
        while True:
            words = rows  # noqa: F841
            depth = max(1, ROWS_PER_RECURSION // rows.num_rows)
            found = self._db.sql(_LONG, params={"depth": depth}).to_arrow_table()
            rows = found.sort_by("pos")
            if not rows["live"][0].as_py():
                return rows["tok"].to_numpy()
            rows = rows.select(["w", "pos", "tok"])


class PairDecoder:
    """Decodes ids by the ranks of a vocabulary file."""

    def __init__(self, path: str = VOCABULARY) -> None:
        ranks = read_ranks(path)
        chars: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            chars[rank] = token.decode("latin-1")
        listed = pa.array([chars], pa.list_(pa.string()))
        self._db = _database("vocabulary", {"chars": listed})

    def decode_many(self, ids: pa.ListArray) -> list[bytes]:
        """The bytes of each row of ids; unknown ids have none."""
        sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = ids.flatten()
        ends = np.cumsum(sizes)
        out: list[bytes] = []
        first = 0
        while first < len(sizes):
            start = int(ends[first] - sizes[first])
            after = max(first + 1, int(np.searchsorted(ends, start + BLOCK_TOKENS, "right")))
            out += self._decode_rows(sizes[first:after], flat[start : int(ends[after - 1])])
            first = after
        return out

    def _decode_rows(self, sizes: np.ndarray, flat: pa.Array) -> list[bytes]:
        rows = -(-sizes // TOKENS_PER_ROW)
        # Where a document's first token stands, counting the places left free at the ends of rows.
        shift = (np.cumsum(rows) - rows) * TOKENS_PER_ROW - (np.cumsum(sizes) - sizes)
        laid = np.full(int(rows.sum()) * TOKENS_PER_ROW, -1, np.int32)
        known = np.maximum(flat.fill_null(-1).to_numpy(zero_copy_only=False), -1)
        laid[np.arange(len(flat)) + np.repeat(shift, sizes)] = known
        laid = laid.reshape(-1, TOKENS_PER_ROW)
        tokens = pa.table(  # noqa: F841
            {
                "doc": np.repeat(np.arange(len(sizes), dtype=np.int32), rows),
                "place": np.arange(len(laid), dtype=np.int32),
                **{f"t{i}": np.ascontiguousarray(laid[:, i]) for i in range(TOKENS_PER_ROW)},
            }
        )
        found = self._db.sql(_DECODE).to_arrow_table()
        texts = dict(zip(found["doc"].to_pylist(), found["chars"].to_pylist()))
        return [texts.get(i, "").encode("latin-1") for i in range(len(sizes))]


_CODED = "ids: array<int>, n_tokens: bigint, ids_sha256: string"


def _encoded(encoder: PairEncoder, texts: pa.Array) -> list[pa.Array]:
    """Ids, their number and their digest."""
    coded = list(encoder.encode_many(t.as_py() for t in texts))
    sizes = np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
    sums = pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string())
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(sizes), sums]


def _decoded(decoder: PairDecoder, ids: pa.Array) -> pa.Array:
    return pa.array(decoder.decode_many(ids), pa.binary())


def _made(coders: dict, kind: type, path: str):
    """The coder of this task, made for its first batch and gone with the task."""
    if kind not in coders:
        coders[kind] = kind(path)
    return coders[kind]


def encode(
    docs: DataFrame,
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    decoded: bool = False,
) -> DataFrame:
    """``docs`` with ``ids array<int>``, ``n_tokens`` and ``ids_sha256`` (replacing such columns).

    Each match of the public pattern is a word; its bytes are merged by rank as the vocabulary file
    says, without special tokens. A partition keeps the ids of words it has met, up to a bound;
    the others of a block of texts go through one recursive query. ``ids_sha256`` is over the ids
    as little-endian unsigned 32-bit integers. With ``decoded`` the ids are decoded again at once,
    as ``decode`` does, by the same Python worker.

    Defined cases: null and empty texts have no ids; any other text has ids that decode to it, a
    word of any length included; rows are independent, so repeated rows get equal results. The
    vocabulary file has to be at ``vocabulary`` on every executor.
    """
    require(docs, [text_col])
    coders: dict = {}
    names = ["ids", "n_tokens", "ids_sha256", *["decoded"] * decoded]

    @F.arrow_udf(f"struct<{_CODED}{', decoded: binary' if decoded else ''}>")
    def run(texts: pa.Array) -> pa.Array:
        columns = _encoded(_made(coders, PairEncoder, vocabulary), texts)
        if decoded:
            columns.append(_decoded(_made(coders, PairDecoder, vocabulary), columns[0]))
        pa.default_memory_pool().release_unused()
        return pa.StructArray.from_arrays(columns, names=names)

    coded = docs.withColumn("_coded", run.asNondeterministic()(F.col(f"`{text_col}`")))
    return with_columns(coded, {n: F.col(f"_coded.{n}") for n in names}).drop("_coded")


def decode(rows: DataFrame, ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``rows`` with ``decoded binary`` (replacing such a column): the tokens' bytes in order.

    Null or empty ids give no bytes, and so does an id that the vocabulary lacks.
    """
    require(rows, [ids_col])
    coders: dict = {}

    @F.arrow_udf("binary")
    def run(ids: pa.Array) -> pa.Array:
        return _decoded(_made(coders, PairDecoder, vocabulary), ids)

    return with_columns(rows, {"decoded": run(F.col(f"`{ids_col}`"))})


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, decoded=True).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
