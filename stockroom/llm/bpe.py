"""Byte-level BPE encoding and decoding by recursive queries.

A task splits its texts into pattern matches and encodes each distinct match once. Matches that are
no token themselves become rows of a DuckDB table in the task's own process: a match's tokens and,
for each two neighbours, the rank of the token they merge to (null: none). A recursive query
contracts each match's leftmost pair of minimum rank and joins only the two pairs that this makes
with the merge table, until no match has a pair left. An ordered aggregation over the vocabulary
gives the bytes back.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.arrowtext import text_chunks

#: Matches kept with their ids between chunks of text; a bound of memory, not of what is encoded.
CACHE = 400_000
#: Bytes of distinct matches in one recursive query.
QUERY_BYTES = 400_000
#: Ids in one decoding query.
QUERY_IDS = 400_000
#: A recursive query contracts one pair of each match a round, so its work grows with the square of
#: a match's length. Longer matches (runs of thousands of letters or marks) use a queue of pairs.
LONG_MATCH = 400

# The letters and numbers that Unicode 16.0 added, (first, last), for Pythons whose
# ``unicodedata`` is older; the library whose ids are matched follows Unicode 16.0.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)

ENCODE = """
with recursive step(word, tokens, ranks) as (
    select word, tokens, ranks from words_in
  union all
    (with best as (select word, tokens, ranks, list_min(ranks) as merged from step),
     spot as (select *, list_position(ranks, merged) as place from best where merged is not null)
     select s.word, s.tokens[:s.place - 1] || [s.merged] || s.tokens[s.place + 2:],
            s.ranks[:greatest(s.place - 2, 0)]
            || case when s.place > 1 then [b.merged] else [] end
            || case when s.place < len(s.ranks) then [a.merged] else [] end
            || s.ranks[s.place + 2:]
     from spot s left join merges b on b.first = s.tokens[s.place - 1] and b.second = s.merged
                 left join merges a on a.first = s.merged and a.second = s.tokens[s.place + 2])
)
select word, tokens as ids from step where list_min(ranks) is null
"""
DECODE = """
select word, array_to_string(list(chars order by pos), '') as chars
from ids_in join vocabulary using (token) group by word
"""


def read_ranks(path: str) -> bytes:
    """The content of a rank file: a line for each token, its bytes in base64 and its rank."""
    with open(path, "rb") as f:
        return f.read()


def _classes(top: int) -> tuple[str, str, str]:
    """Character class bodies for letters, numbers and white space below ``top``."""
    spaces = {*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
    letters = {c for a, b in NEW_LETTERS for c in range(a, b + 1)}
    numbers = {c for a, b in NEW_NUMBERS for c in range(a, b + 1)}
    out = []
    for kind, more in (("L", letters), ("N", numbers), ("", spaces)):
        flags = np.array([0, *(c in more or unicodedata.category(chr(c))[0] == kind for c in range(top)), 0], np.int8)
        edges = np.flatnonzero(np.diff(flags))
        out.append("".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2])))
    return tuple(out)


class Splitter:
    """The matches of a split pattern. The pattern's Unicode classes are written out as ranges,
    since ``re`` has none; texts within the basic plane use the shorter, faster ones."""

    def __init__(self, pattern: str):
        self.pattern, self.plane, self.full = pattern, self._compiled(pattern, 0x10000), None

    @staticmethod
    def _compiled(pattern: str, top: int) -> re.Pattern:
        letters, numbers, spaces = _classes(top)
        body = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
        return re.compile(body.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]"))

    def __call__(self, text: str) -> list[str]:
        if not text:
            return []
        if text.isascii() or max(text) <= "\uffff":
            return self.plane.findall(text)
        self.full = self.full or self._compiled(self.pattern, sys.maxunicode + 1)
        return self.full.findall(text)


class Codec:
    """Encodes matches and decodes ids in one process."""

    def __init__(self, rank_file: bytes, memory: str = "256MB"):
        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, rank_file.splitlines())}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.double = np.full((256, 256), -1, np.int32)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.double[token[0], token[1]] = rank
        self.known: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        cuts = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        merges = pa.table([pa.array(c, pa.int32()) for c in zip(*cuts)] if cuts else [pa.array([], pa.int32())] * 3, ["first", "second", "merged"])
        vocabulary = pa.table([pa.array(list(self.ranks.values()), pa.int32()), pa.array([t.decode("latin-1") for t in self.ranks])], ["token", "chars"])
        for name, table in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", table)
            self.db.execute(f"create table {name} as select * from given")
            self.db.unregister("given")

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    @staticmethod
    def _rows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = np.repeat(np.arange(len(lengths)), lengths)
        return words, np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)

    def _contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of ``words`` as little-endian 32-bit integers, by the recursive query."""
        data, lengths = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        pairs = np.delete(self.double[data, np.roll(data, -1)], ends - 1)  # none across two words
        tokens = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), self.single[data])
        ranks = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths - 1)]).astype(np.int32), pa.array(pairs, mask=pairs < 0))
        found = self._query(ENCODE, "words_in", pa.table([np.arange(len(words), dtype=np.int32), tokens, ranks], ["word", "tokens", "ranks"]))
        ids = found["ids"].combine_chunks()
        values, edges = ids.flatten().to_numpy().astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(ids).to_numpy())]).tolist()
        out = [b""] * len(words)
        for k, word in enumerate(found["word"].to_pylist()):
            out[word] = values[4 * edges[k] : 4 * edges[k + 1]]
        return out

    def _contract_long(self, word: bytes) -> bytes:
        """The same ids for one long match: pairs wait in a queue by (rank, place)."""
        n = len(word)
        after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        queue: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < n and (rank := self.ranks.get(word[i : ends[j]])) is not None:
                heapq.heappush(queue, (rank, i, ends[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, end = heapq.heappop(queue)
            if after[i] is None or (j := after[i]) >= n or ends[j] != end:
                continue  # one side has been contracted since
            ends[i], after[i], after[j] = end, after[j], None
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        starts = [i for i in range(n) if after[i] is not None]
        return np.array([self.ranks[word[i : ends[i]]] for i in starts], "<u4").tobytes()

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each id sequence, by the ordered aggregation; a query has ``QUERY_IDS`` ids
        at most, so a very long sequence is decoded in parts."""
        parts, group, held = [[] for _ in ids], [], 0

        def flush() -> None:
            lengths = np.array([len(x) // 4 for _, x in group], np.int64)
            columns = (*self._rows(lengths), np.frombuffer(b"".join(x for _, x in group), "<u4"))
            found = self._query(DECODE, "ids_in", pa.table([c.astype(np.int32) for c in columns], ["word", "pos", "token"]))
            chars = dict(zip(found["word"].to_pylist(), found["chars"].to_pylist()))
            for k, (i, _) in enumerate(group):
                parts[i].append(chars[k].encode("latin-1"))

        for i, whole in enumerate(ids):
            for at in range(0, len(whole), 4 * QUERY_IDS):
                group.append((i, part := whole[at : at + 4 * QUERY_IDS]))
                held += len(part) // 4
                if held >= QUERY_IDS:
                    flush()
                    group, held = [], 0
        if group:
            flush()
        return [b"".join(p) for p in parts]

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of ``pieces``: of tokens directly, of others by contraction."""
        new, short = {}, []
        for piece in pieces:
            word = piece.encode()
            if (whole := self.ranks.get(word)) is not None:
                new[piece] = whole.to_bytes(4, "little")
            elif len(word) > LONG_MATCH:
                new[piece] = self._contract_long(word)
            else:
                short.append((piece, word))
        start = held = 0
        for i, (_, word) in enumerate(short):
            held += len(word)
            if held >= QUERY_BYTES or i == len(short) - 1:
                part = short[start : i + 1]
                new.update(zip([p for p, _ in part], self._contract([w for _, w in part])))
                start, held = i + 1, 0
        return new

    def ids_of(self, splits: list[list[str]]) -> list[bytes]:
        """The ids of each text, given as its matches."""
        known = self.known
        missing = set().union(*splits).difference(known) if splits else set()
        extra = self.learn(missing) if missing else {}
        if len(known) < CACHE:
            known.update(extra)
            extra = {}
        if not extra:
            return [b"".join(map(known.__getitem__, pieces)) for pieces in splits]
        return [b"".join([known.get(p) or extra[p] for p in pieces]) for pieces in splits]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for each row of ``docs`` (doc_id, text).

    ``ids`` holds the ids as little-endian unsigned 32-bit integers, ``decoded`` the bytes that the
    ids decode to. The ids are those of a byte-level BPE with the ranks of the file at
    ``ranks_path`` on the driver, whose content goes to the executors; special tokens are ordinary
    text. A null text counts as empty and has no ids. Repeated rows and null ids are rows like any
    other, an empty table gives an empty result, and other columns are not read. Nothing is
    shuffled; a task works on about 4 MB of text at a time.
    """
    rank_file = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, split = Codec(rank_file.value), Splitter(pattern)
        for batch in text_chunks(batches):
            ids = codec.ids_of([split(t or "") for t in batch.column("text").to_pylist()])
            columns = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(codec.decode(ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids binary, decoded binary")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, decoded) for each row of ``encoded`` (doc_id, ids); null ids decode to no bytes."""
    rank_file = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(rank_file.value)
        for batch in text_chunks(batches, "ids"):
            found = codec.decode([x or b"" for x in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decode, "doc_id long, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``encode_documents`` rows, one per row; a null
    or empty text has no ids, and its digests are those of the empty string."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
