"""Removal of repeated byte strings by suffix arrays.

A string of ``LENGTH`` bytes that starts at p has a guide: the place in it whose 20 bytes have the
smallest hash. Equal strings have guides of equal hash, so strings are dealt to shards by that hash
and all occurrences of a string meet in one shard, without comparing shards pair by pair.

1. A pass over the texts finds guides. A hash that a chunk of text has twice, or that two chunks
   have, is repeated; only then can a string with this guide be.
2. For repeated guides the bytes of the strings that they guide (neighbouring strings with one guide
   form one piece of text) go to the guide's shard.
3. A shard keeps the first of equal pieces and builds the suffix array of the others by
   Larsson-Sadakane refinement. Kasai's common prefixes cut it into runs of suffixes that agree on
   ``LENGTH`` bytes; all but the first occurrence of a run are repeated.
4. A guide that very many texts hold is split over several shards. Their first occurrences are
   sorted strings, merged across the shards by binary search.
5. The repeated strings of a document are united and cut from its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.arrowtext import text_chunks
from stockroom.llm.itemwords import binary_bytes, text_bytes
from stockroom.session import materialize

LENGTH = 100
#: Bytes that a guide's hash covers.
GUIDE = 20
#: Bytes of pieces in a shard, about, and in one suffix array.
SHARD_BYTES = 8 << 20
ARRAY_BYTES = 1 << 20
#: Chunks with a guide above which its pieces are split over several shards.
HOT_CHUNKS = 2000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


# ---- suffix arrays ------------------------------------------------------------------------------
def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + len(text)]
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (bytes) in order of their first ``depth`` bytes or more.

    Larsson and Sadakane: with suffixes grouped by their first h bytes, the group of the suffix h
    bytes later orders each group by 2h bytes. A group's number is the place of its last member,
    and groups of one member are left alone from then on."""
    n = len(text)
    first = _words(text)
    order = np.argsort(first, kind="stable")
    last = np.flatnonzero(np.append(first[order[1:]] != first[order[:-1]], True))
    sizes = np.diff(np.concatenate([[-1], last]))
    group = np.empty(n + 1, np.int64)
    group[order] = np.repeat(last, sizes)
    group[n] = -1
    open_places = np.flatnonzero(np.repeat(sizes > 1, sizes))
    h = 8
    while h < depth and len(open_places):
        members = order[open_places]
        own, later = group[members], group[np.minimum(members + h, n)]
        by = np.lexsort((later, own))
        members, own, later = members[by], own[by], later[by]
        order[open_places] = members
        ends = np.append((own[1:] != own[:-1]) | (later[1:] != later[:-1]), True)
        last = np.flatnonzero(ends)
        sizes = np.diff(np.concatenate([[-1], last]))
        group[members] = np.repeat(open_places[last], sizes)
        open_places = open_places[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of the suffix array the bytes that its suffix shares with the one before it.

    Kasai: in text order, a suffix shares at least one byte less with its predecessor in the array
    than the suffix one place earlier does. It shares just that if the bytes before both are equal,
    so only the other places are compared, eight bytes a step."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (text[:-1] == text[np.maximum(before[1:], 1) - 1]) & (before[:-1] >= 0)
    # the predecessor one place earlier must be the one whose next suffix is this predecessor
    follows[1:] &= before[1:] == before[:-1] + 1
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(~follows & (before >= 0))
    words = np.append(_words(text), np.zeros(1, np.uint64))
    while len(live):
        a, b = live + shared[live], before[live] + shared[live]
        room = n - np.maximum(a, b)
        x = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        same = sum(((x >> np.uint64(shift)) == 0).astype(np.int64) for shift in range(0, 64, 8))
        same = np.minimum(same, room)
        shared[live] += same
        live = live[(same == 8) & (room > 8)]
    base = np.maximum.accumulate(np.where(follows, 0, place))
    shared = np.where(follows, np.maximum(shared[base] - (place - base), 0), shared)
    return shared[order]


def repeated_starts(text: np.ndarray, valid: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Places of ``text`` with ``valid`` whose next ``length`` bytes also start at an earlier valid
    place. Valid strings must hold no byte 0, with which pieces end."""
    order = suffix_array(text, length)
    cut = common_prefixes(text, order) < length
    runs = np.flatnonzero(cut)
    sizes = np.diff(np.append(runs, len(order)))
    firsts = np.repeat(np.minimum.reduceat(order, runs), sizes)
    out = order[(firsts != order) & valid[order]]
    return np.sort(out)


# ---- guides -------------------------------------------------------------------------------------
_BLOCK = 1 << 15  # places worked on at a time, so that the arrays stay in the processor's cache


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the ``GUIDE`` bytes from each place on, with 8 low bits of 0: polynomials of 2, 4, 8
    and 16 bytes, each from two of the size before."""
    n = len(data) - GUIDE + 1
    out = np.empty(n, np.uint64)
    powers = {1: int(_ODD)}
    for k in (2, 4, 8):
        powers[k] = powers[k // 2] ** 2 % 2**64
    for a in range(0, n, _BLOCK):
        b = min(n, a + _BLOCK)
        h = data[a : b + GUIDE - 1].astype(np.uint64) + np.uint64(1)
        four = h
        for k in (1, 2, 4, 8):
            h = h[:-k] * np.uint64(powers[k]) + h[k:]
            four = h if k == 2 else four
        h = h[:-4] * np.uint64(powers[4]) + four[16:]
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        out[a:b] = h & ~np.uint64(255)
    return out


def _least(keys: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` neighbouring keys."""
    width = 1
    while 2 * width <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    return np.minimum(keys[: len(keys) - (span - width)], keys[span - width :]) if width < span else keys


def guides(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(document, first, last, hash, looped) of the pieces of concatenated texts that end at ``ends``:
    strings that start at first..last (places in ``data``) have one guide. A piece is looped if its
    guide's bytes recur within it, so that strings of the piece itself may be equal."""
    n, span = len(data), length - GUIDE + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, np.zeros(0, bool)
    grams, low = _hashes(data), np.uint64(255)
    # of equal hashes the place with the smaller low byte is the guide; with the order of places
    # turned round, another place is least just where the hash occurs twice in the string
    value, twice = np.empty(n - length + 1, np.uint64), np.empty(n - length + 1, bool)
    for a in range(0, len(value), _BLOCK):
        b = min(len(value), a + _BLOCK)
        hashes = grams[a : b + span - 1]
        place = np.arange(a, a + len(hashes), dtype=np.uint64) & low
        value[a:b] = _least(hashes | place, span)
        twice[a:b] = (value[a:b] & low) != low - (_least(hashes | (low - place), span) & low)
    starts = np.concatenate([[0], ends[:-1]])
    doc = np.repeat(np.arange(len(ends)), ends - starts)[: len(value)]
    places = np.flatnonzero(np.arange(len(value)) + length <= ends[doc])
    if not len(places):
        return none, none, none, none, np.zeros(0, bool)
    least, of = value[places], doc[places]
    new = np.append(True, (least[1:] != least[:-1]) | (of[1:] != of[:-1]) | (places[1:] != places[:-1] + 1))
    at = np.flatnonzero(new)
    first, last = places[at], places[np.append(at[1:], len(places)) - 1]
    # all strings of a piece hold its guide; a second place of the hash is in the first or the last of them
    return of[at], first, last, (least[at] >> np.uint64(8)).astype(np.int64), twice[first] | twice[last]


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(texts)
    return data, bounds[1:]


def repeated_guides(rows: DataFrame) -> DataFrame:
    """(doc, guides): for each document key the repeated guides of its text, with the number of
    shards that each is split over. ``rows``: doc, text.

    A chunk of text sends one row for each of its guides, so a guide that a third of all texts hold
    arrives once from each chunk."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            docs = batch.column("doc").to_numpy()
            of, _, _, hashes, looped = guides(*_joined(batch.column("text")))
            order = np.lexsort((of, hashes))
            hashes, of, looped = hashes[order], of[order], looped[order]
            head = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
            sizes = np.diff(np.append(head, len(hashes)))
            single = (sizes == 1) & ~(np.logical_or.reduceat(looped, head) if len(head) else np.zeros(0, bool))
            # the other documents of a guide: wherever the document changes within its rows
            change = np.append(False, (hashes[1:] == hashes[:-1]) & (of[1:] != of[:-1]))[: len(hashes)]
            more = np.add.reduceat(change.astype(np.int64), head) if len(head) else np.zeros(0, np.int64)
            offsets = np.append(0, np.cumsum(more))
            others = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(docs[of[change]]), mask=pa.array(single))
            yield pa.RecordBatch.from_arrays([pa.array(hashes[head]), pa.array(docs[of[head]]), others], ["guide", "doc", "others"])

    found = rows.mapInArrow(find, "guide long, doc long, others array<long>")
    counted = found.withColumn("chunks", F.count(F.lit(1)).over(Window.partitionBy("guide")))
    repeated = counted.where("chunks > 1 or others is not null")
    holders = F.concat(F.array("doc"), F.coalesce("others", F.array().cast("array<long>")))
    each = repeated.select(F.explode(holders).alias("doc"), "guide", F.ceil(F.col("chunks") / HOT_CHUNKS).cast("int").alias("shards"))
    return each


PIECES = "guide long, shards int, doc_id long, doc long, start long, looped boolean, piece binary, n_bytes int"


def _firsts(code: np.ndarray, ids: pa.Array, docs: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each row the first row, in document order (null id first), with the same code."""
    has_id = np.asarray(ids.is_valid())
    order = np.lexsort((start, docs, np.asarray(ids.fill_null(0)), has_id))
    known, first = np.unique(code[order], return_index=True)
    return order[first][np.searchsorted(known, code)]


def repeated_pieces(rows: DataFrame) -> DataFrame:
    """``PIECES`` of ``rows`` (doc_id, doc, text, guides array of (guide, shards)). Of equal pieces of a
    chunk of text only the first in document order has its bytes; the others are repeats as a whole,
    whatever other chunks hold, and have null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            data, ends = _joined(batch.column("text"))
            of, first, last, hashes, looped = guides(data, ends)
            lists = batch.column("guides")
            lengths = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            if not len(flat):
                continue
            asked, shards = flat.field("guide").to_numpy(), flat.field("shards").to_numpy()
            key = lambda h, d: h.astype(np.uint64) * _ODD + d.astype(np.uint64) * _MIX
            wanted = key(asked, np.repeat(np.arange(len(lengths)), lengths))
            by = np.argsort(wanted)
            own = key(hashes, of)
            at = np.minimum(np.searchsorted(wanted[by], own), len(wanted) - 1)
            hit = wanted[by][at] == own
            of, first, last, hashes, looped, split = of[hit], first[hit], last[hit], hashes[hit], looped[hit], shards[by][at[hit]]
            raw = data.tobytes()
            begin = np.concatenate([[0], ends[:-1]])
            pieces = [raw[a : b + LENGTH] for a, b in zip(first.tolist(), last.tolist())]
            pieces, start = pa.array(pieces, pa.binary()), first - begin[of]
            ids, docs = batch.column("doc_id").take(pa.array(of)), batch.column("doc").take(pa.array(of))
            code = np.asarray(pieces.dictionary_encode().indices)
            own = _firsts(code, ids, docs.to_numpy(), start)
            later = pa.array((docs.to_numpy() != docs.to_numpy()[own]) | (start != start[own]))
            blank = pa.compute.if_else(later, pa.scalar(None, pa.binary()), pieces)
            size = pa.compute.binary_length(pieces).cast(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), pa.array(split, pa.int32()), ids, docs, pa.array(start), pa.array(looped), blank, size],
                ["guide", "shards", "doc_id", "doc", "start", "looped", "piece", "n_bytes"],
            )

    return rows.mapInArrow(cut, PIECES)


# ---- shards -------------------------------------------------------------------------------------
#: Starts first..last of repeated strings of a document; or, with a window, the first occurrence in
#: a shard of a string whose guide is split over several shards.
SPANS = "doc long, first long, last long, window binary, has_id boolean, doc_id long, shard long"
_SPANS = pa.schema([("doc", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("window", pa.binary()), ("has_id", pa.bool_()), ("doc_id", pa.int64()), ("shard", pa.int64())])


def _spans(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(c), k.type) for c, k in zip(zip(*rows), _SPANS)], schema=_SPANS) if rows else _SPANS.empty_table()


def _plain_spans(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Table:
    rest = [pa.nulls(len(doc), field.type) for field in list(_SPANS)[3:]]
    return pa.Table.from_arrays([pa.array(doc, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()), *rest], schema=_SPANS)


def _settle(pieces: pa.Array, has_id: np.ndarray, ids: np.ndarray, doc: np.ndarray, start: np.ndarray, split: np.ndarray, shard: int) -> list[pa.Table]:
    """Spans of different pieces, those of a guide in document order, by one suffix array. Byte 255,
    which UTF-8 never has, stands for byte 0, with which a piece ends."""
    data, bounds = binary_bytes(pieces)
    sizes = np.diff(bounds)
    begin = bounds[:-1] + np.arange(len(sizes))
    text = np.zeros(len(data) + len(sizes), np.uint8)
    text[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = np.where(data == 0, np.uint8(255), data)
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + sizes - LENGTH + 1, -1)
    starts = repeated_starts(text, np.cumsum(edge)[:-1] > 0)
    which = np.searchsorted(begin, starts, "right") - 1
    head = np.flatnonzero(np.append(True, (np.diff(starts) != 1) | (np.diff(which) != 0))[: len(starts)])
    tail = np.append(head[1:], len(starts))[: len(head)] - 1
    own = which[head]
    out = [_plain_spans(doc[own], start[own] + starts[head] - begin[own], start[own] + starts[tail] - begin[own])]
    later = np.zeros(len(text), bool)
    later[starts] = True
    rows = []
    for k in np.flatnonzero(split).tolist():
        piece, at = pieces[k].as_py(), int(begin[k])
        fresh = np.flatnonzero(~later[at : at + len(piece) - LENGTH + 1]).tolist()
        s = int(start[k])
        rows.extend((int(doc[k]), s + i, s + i, piece[i : i + LENGTH], bool(has_id[k]), int(ids[k]), shard) for i in fresh)
    return [*out, _spans(rows)]


def settle_shard(table: pa.Table) -> pa.Table:
    """``SPANS`` of the pieces of a shard. Of equal pieces the first in document order (null id first,
    then id, text key, place) stays, and those without bytes never are first; different pieces of a
    guide, and looped ones, go to suffix arrays of about ``ARRAY_BYTES`` each."""
    shard = table["shard"][0].as_py()
    blank = table.filter(pa.compute.is_null(table["piece"]))
    doc, start, size = (blank[c].to_numpy() for c in ("doc", "start", "n_bytes"))
    out = [_plain_spans(doc, start, start + size - LENGTH)]
    table = table.filter(pa.compute.is_valid(table["piece"])).combine_chunks()
    if not len(table):
        return out[0]
    encoded = table["piece"].combine_chunks().dictionary_encode()
    code, ids = np.asarray(encoded.indices), table["doc_id"].combine_chunks()
    doc, start, size, guide, shards, looped = (table[c].to_numpy() for c in ("doc", "start", "n_bytes", "guide", "shards", "looped"))
    own = _firsts(code, ids, doc, start)
    # rows with equal id and text are one document: none of them repeats the other
    later = np.flatnonzero((doc != doc[own]) | (start != start[own]))
    out.append(_plain_spans(doc[later], start[later], start[later] + size[later] - LENGTH))
    has_id, ids = np.asarray(ids.is_valid()), np.asarray(ids.fill_null(0))
    kept = np.unique(own)
    kept = kept[np.lexsort((start[kept], doc[kept], ids[kept], has_id[kept], guide[kept]))]
    head = np.flatnonzero(np.append(True, np.diff(guide[kept]) != 0))
    count = np.diff(np.append(head, len(kept)))
    open_guide = (count > 1) | np.logical_or.reduceat(looped[kept] | (shards[kept] > 1), head)
    chosen = kept[np.repeat(open_guide, count)]
    if len(chosen):
        sizes = np.add.reduceat(size[kept].astype(np.int64), head)[open_guide]
        part = np.repeat((np.cumsum(sizes) - sizes) // ARRAY_BYTES, count[open_guide])
        for rows in np.split(chosen, np.flatnonzero(np.diff(part)) + 1):
            pieces = encoded.dictionary.take(pa.array(code[rows]))
            out.extend(_settle(pieces, has_id[rows], ids[rows], doc[rows], start[rows], shards[rows] > 1, shard))
    return pa.concat_tables(out)


def merge_shards(table: pa.Table) -> pa.Table:
    """Spans of a bucket: those without a window as they are, and of strings that first occurred in
    several shards all occurrences but the first. Each shard's strings are sorted and looked up in
    the merged ones by binary search."""
    plain = table.select(_SPANS.names).filter(pa.compute.is_null(table["window"]))
    rows = table.filter(pa.compute.is_valid(table["window"])).to_pylist()
    out: list[tuple] = []
    shards: dict[int, list[tuple]] = {}
    for r in rows:
        if r["window"] is not None:
            shards.setdefault(r["shard"], []).append((r["window"] + b"\1", (r["has_id"], r["doc_id"], r["doc"], r["first"])))
    merged, firsts = np.zeros(0, f"S{LENGTH + 1}"), np.zeros(0, object)
    for strings in shards.values():
        strings.sort()
        words, places = np.array([w for w, _ in strings], f"S{LENGTH + 1}"), np.empty(len(strings), object)
        places[:] = [p for _, p in strings]
        at = np.searchsorted(merged, words)
        known = np.zeros(len(words), bool)
        inside = at < len(merged)
        known[inside] = merged[at[inside]] == words[inside]
        for k in np.flatnonzero(known).tolist():
            held, new = firsts[at[k]], places[k]
            firsts[at[k]], late = (held, new) if held < new else (new, held)
            out.append((late[2], late[3], late[3], None, None, None, None))
        merged, firsts = np.insert(merged, at[~known], words[~known]), np.insert(firsts, at[~known], places[~known])
    return pa.concat_tables([plain.cast(_SPANS), _spans(out)])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut_texts(rows: DataFrame) -> DataFrame:
    """``RESULT`` for each of ``rows`` (doc_id, text, spans array of (first, last) or null)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            sizes, removed, runs, kept = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data, merged = (text or "").encode(), []
                for first, last in sorted((s["first"], s["last"] + LENGTH) for s in spans or ()):
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], last)
                    else:
                        merged.append([first, last])
                edges = [0, *(x for span in merged for x in span), len(data)]
                sizes.append(len(data))
                removed.append(sum(b - a for a, b in merged))
                runs.append(len(merged))
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.select("doc_id", "text", "spans").mapInArrow(cut, RESULT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs) and the ``kept`` bytes.

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
    document with a smaller id, or earlier in the same document. All strings are judged on the input.
    Null ids come first; different texts under one id come in order of a hash; rows with equal id
    and text are one document and are cut alike. A null text is empty, shorter texts lose nothing,
    and cuts may fall within a character, so ``kept`` is binary. An empty table gives an empty
    result; other columns are not read. Texts are dealt out once, by a key of the row; documents are
    told apart by that 64-bit key together with their id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    held = materialize(repeated_guides(rows.select("doc", "text")), "guides")
    n_shards = max(1, held.count() * 190 // SHARD_BYTES)
    lists = held.groupBy("doc").agg(F.collect_list(F.struct("guide", "shards")).alias("guides"))
    # both sides of the text joins grow with the input, so neither is to be broadcast at any size
    listed = rows.hint("merge").join(lists, "doc", "left").select("doc_id", "doc", "text", "guides")
    salt = F.when(F.col("shards") > 1, F.pmod(F.xxhash64("doc"), F.col("shards"))).otherwise(F.lit(0))
    pieces = repeated_pieces(listed).withColumn("shard", F.pmod(F.xxhash64("guide", salt), F.lit(n_shards)))
    settled = pieces.groupBy("shard").applyInArrow(settle_shard, SPANS)
    route = F.pmod(F.when(F.col("window").isNull(), F.xxhash64("doc")).otherwise(F.xxhash64("window")), F.lit(n_shards))
    spans = settled.withColumn("route", route).groupBy("route").applyInArrow(lambda t: merge_shards(t.drop(["route"])), SPANS)
    by_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return cut_texts(rows.hint("merge").join(by_doc, "doc", "left").select("doc_id", "doc", "text", "spans"))


def digests(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
