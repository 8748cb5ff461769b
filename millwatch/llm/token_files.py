"""Token ids of whole collections in compressed files, in ascending order of documents.

A file holds whole documents: a header with the code lengths, blocks of at most BLOCK ids (each with its number of
ids, checkpoints, bits and CRC, decodable alone), a list of documents, and a footer that says where the list is.
Codes are the canonical length-limited Huffman codes of the ids' counts in the whole collection.

Steps: range-sort the texts by id and encode them (saved, with each task's counts of ids); sum the counts (combined
before the shuffle, one row per id of the vocabulary reaches the driver); write files that roll at ROLL ids under
temporary names; rename those of the tasks that succeeded, with a manifest; read back by the manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch.llm import huffman, octets
from millwatch.llm.store import BATCH_ROWS, NO_ID, Tidy, arrow_schema, committed, folder, id_key, octets_of, one_per_task, open_store, record, saved

MAGIC = b"MWTOKEN1"
BLOCK = 1 << 16
#: Blocks that are decoded together.
TOGETHER_BLOCKS = 8
ROLL = 1 << 23
#: Parts of texts that a worker remembers the ids of, from one task to the next.
REMEMBERED = 500_000
LONGEST = 64
#: Bytes of text that are cut into parts together, about twice as many at most; a longer text may be more.
BATCH_BYTES = 16 << 20
#: Unknown parts that one call of the library takes, and how many of them it takes as one text.
CALL = 16_384
TOGETHER = 128
#: What a byte is: white space of one byte, a space, a line feed, punctuation, a letter or digit, the first byte of a letter of
#: two (and the second of what may be none).
BLANK, SPACE, LINE, MARK, ALNUM, LEAD, UNSURE = (1 << k for k in range(7))
_SETS = {
    BLANK: [*range(0x09, 0x0E), *range(0x1C, 0x21)],
    SPACE: [0x20],
    LINE: [0x0A],
    MARK: [b for b in range(0x21, 0x7F) if not chr(b).isalnum()],
    ALNUM: [b for b in range(0x80) if chr(b).isalnum()],
    LEAD: [0xC3, 0xC4, 0xC5, 0xD0, 0xD1],
    UNSURE: [0x97, 0xB7],
}
KINDS = bytes(sum(k for k, some in _SETS.items() if b in some) for b in range(256))
#: White space of more bytes: the first, and what may follow.
WIDE_BLANK = {0xC2: [b"\x85", b"\xa0"], 0xE1: [b"\x9a\x80", b"\xa0\x8e"], 0xE2: [*(bytes([0x80, b]) for b in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\x81\x9f"], 0xE3: [b"\x80\x80"]}


def _kinds(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(KINDS), np.uint8)


def _white(data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    white = (kinds & BLANK).astype(bool)
    for first, rests in WIDE_BLANK.items():
        at = np.flatnonzero(data == first)
        for rest in rests:
            here = at[at + len(rest) < len(data)]
            for k, byte in enumerate(rest, 1):
                here = here[data[here + k] == byte]
            for k in range(len(rest) + 1):
                white[here + k] = True
    return white


def cuts(data: np.ndarray, starts: np.ndarray, fine: bool) -> np.ndarray:
    """Where the parts of texts begin: at each text's start (distinct, the first 0) and where a pre-token surely does.

    That is at a space alone between two characters that are no white space; if `fine`, also before and after such a
    line feed, and between a letter (ASCII, Latin or Cyrillic) or ASCII digit and ASCII punctuation. Fine cuts are
    those of GPT-2's pattern.
    """
    kinds = _kinds(data)
    white = _white(data, kinds)
    begins = np.zeros(len(data) + 1, bool)
    begins[starts] = begins[-1] = True
    alone = white.copy()
    alone[1:] &= ~white[:-1]
    alone[:-1] &= ~white[1:]
    alone &= ~(begins[:-1] | begins[1:])  # nothing is beside an end
    out = begins[:-1] | (alone & (kinds & SPACE > 0))
    if fine:
        line = alone & (kinds & LINE > 0)
        out |= line
        out[1:] |= line[:-1]
        letter = kinds & ALNUM > 0
        letter[1:] |= (kinds[:-1] & LEAD > 0) & (kinds[1:] & UNSURE == 0)
        out[1:] |= letter[:-1] & (kinds[1:] & MARK > 0)
    return np.flatnonzero(out)


class _Known:
    """Parts of texts of one type and their ids, at most REMEMBERED from one look to the next."""

    def __init__(self, kind: pa.DataType) -> None:
        self.parts, self.ids = pa.array([], kind), pa.array([], pa.large_binary())
        self.uses = np.zeros(0, np.int64)

    def look(self, parts: pa.Array, ids_of: Callable[[pa.Array], pa.LargeBinaryArray], keep: Callable[[pa.Array], np.ndarray]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """Ids of distinct parts, and the place of each part among them. `ids_of` is asked for new ones; those that `keep` says are remembered."""
        n = len(self.parts)
        # the remembered parts come first and so are known by their places
        coded = pa.concat_arrays([self.parts, parts]).dictionary_encode()
        places = coded.indices.to_numpy()[n:].astype(np.int64)
        ids = pa.concat_arrays([self.ids, ids_of(coded.dictionary.slice(n))])
        uses = np.bincount(places, minlength=len(ids))
        uses[:n] += self.uses >> 1  # older uses count less and less
        kept = np.flatnonzero(keep(coded.dictionary))
        if (more := len(kept) - REMEMBERED) > 0:  # those used most
            kept = np.sort(kept[np.argpartition(uses[kept], more)[more:]])
        self.parts, self.ids, self.uses = coded.dictionary.take(pa.array(kept)), ids.take(pa.array(kept)), uses[kept]
        return ids, places


class _Library:
    """Ids by the tokenizers library; parts of texts are encoded once and remembered.

    Texts are cut where a pre-token begins whatever stands around, and no merge crosses pre-tokens, so the ids of a
    text are those of its parts. Ids are kept in `kind`, the narrowest numbers that hold the vocabulary.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        way = self.tokenizer.pre_tokenizer
        self.fine = self.tokenizer.normalizer is None and isinstance(way, pre_tokenizers.ByteLevel) and way.use_regex and not way.add_prefix_space
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.leads = {}
        for lead, symbol in ((" ", "Ġ"), ("\n", "Ċ")):
            self.leads[lead] = np.zeros(max(vocabulary.values()) + 1, bool)
            self.leads[lead][[i for symbols, i in vocabulary.items() if symbols.startswith(symbol)]] = True
        self.line = vocabulary.get("Ċ", 0)
        self.forget()

    def forget(self) -> None:
        self.short, self.long = _Known(pa.uint64()), _Known(pa.large_binary())

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        return self.encode_array(pa.array([t.encode() for t in texts], pa.large_binary())).to_pylist()

    def encode_array(self, texts: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of each text (none null): every distinct part is looked up once, and its ids are dealt out."""
        ends, data = _buffers(texts)
        if not len(data):
            return texts
        bounds = np.append(cuts(data, np.unique(ends[:-1][ends[:-1] < len(data)]), self.fine), len(data))
        starts, sizes = bounds[:-1], np.diff(bounds)
        # parts of at most 7 bytes are numbers, with their size as the highest byte
        less = sizes < 8
        eight = np.ndarray(len(data), "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
        sized = np.arange(8, dtype=np.uint64)
        keys = eight[starts[less]] & ((np.uint64(1) << np.uint64(8) * sized) - np.uint64(1))[sizes[less]] | (sized << np.uint64(56))[sizes[less]]
        short, at_short = self.short.look(pa.array(keys), lambda new: self.apart(_unpacked(new.to_numpy())), lambda known: np.ones(len(known), bool))
        long, at_long = self.long.look(_binary(bounds, data).filter(pa.array(~less)), self.apart, lambda known: np.diff(_buffers(known)[0]) <= LONGEST)
        places = np.empty(len(starts), np.int64)
        places[less], places[~less] = at_short, at_long + len(short)
        at, dealt = _buffers(pa.concat_arrays([short, long]).take(pa.array(places)))
        return _binary(at[np.searchsorted(bounds, ends)], dealt)

    def apart(self, parts: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of distinct parts, none empty: many by one text, where all have a space in front, or none has (those are put on lines)."""
        if not len(parts):
            return parts
        at, data = _buffers(parts)
        inside = np.append(0, np.cumsum(_white(data, _kinds(data))))
        spaced = data[at[:-1]] == 0x20
        odd = np.diff(inside[at]) > spaced  # with other white space
        groups = [np.flatnonzero(g) for g in (spaced & ~odd, ~spaced & ~odd, odd)]
        lined = self.together if self.fine else self.alone
        done = [f(parts.take(pa.array(g)), lead) for f, g, lead in zip((self.together, lined, self.alone), groups, " \n ", strict=True)]
        return pa.concat_arrays(done).take(pa.array(np.argsort(np.concatenate(groups))))

    def alone(self, parts: pa.LargeBinaryArray, _: str) -> pa.LargeBinaryArray:
        texts = [w.decode() for w in _list(parts)]
        return pa.array([ids for i in range(0, len(texts), CALL) for ids in self.whole(texts[i : i + CALL])], pa.large_binary())

    def together(self, parts: pa.LargeBinaryArray, lead: str) -> pa.LargeBinaryArray:
        """Ids of parts without white space but `lead` in front, which is a space of their own or a line feed put there."""
        texts = _list(parts)
        pieces = [texts[i : i + TOGETHER] for i in range(0, len(texts), TOGETHER)]
        joined = [(b"".join(p) if lead == " " else b"\n".join([b"", *p])).decode() for p in pieces]
        out, leads = [], self.leads[lead]
        for start in range(0, len(pieces), CALL // TOGETHER):
            turn = slice(start, start + CALL // TOGETHER)
            for some, packed in zip(pieces[turn], self.whole(joined[turn]), strict=True):
                ids = np.frombuffer(packed, self.kind)
                at = np.flatnonzero(leads[ids])
                if len(at) != len(some) or (at[0] if len(at) else 0) or (lead != " " and (ids[at] != self.line).any()):  # a vocabulary of another kind
                    out.append(pa.array(self.whole([w.decode() for w in some]), pa.large_binary()))
                    continue
                if lead != " ":
                    ids, at = np.delete(ids, at), at - np.arange(len(at))
                out.append(_binary(np.append(at, len(ids)) * self.kind.itemsize, ids))
        return pa.concat_arrays(out) if out else parts


def _binary(bounds: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    """Pieces of data, from each bound to the next."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)])


def _list(values: pa.LargeBinaryArray) -> list[bytes]:
    return values.to_numpy(zero_copy_only=False).tolist()


def _unpacked(keys: np.ndarray) -> pa.LargeBinaryArray:
    """The parts that numbers stand for."""
    sizes = (keys >> np.uint64(56)).astype(np.int64)
    return _binary(np.append(0, np.cumsum(sizes)), keys.astype("<u8").view(np.uint8).reshape(-1, 8)[np.arange(8) < sizes[:, None]])


def _buffers(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the values, from 0 on, and their bytes."""
    if not len(values):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, bounds, data = values.buffers()
    bounds = np.frombuffer(bounds, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return bounds - bounds[0], data[bounds[0] : bounds[-1]]


@lru_cache(maxsize=2)
def library(path: str) -> _Library:
    return _Library(path)


#: Rows that the first step writes: documents, and one row per task with how often it met each id (`counts`, 64-bit).
ENCODED = "id long, width int, ids binary, counts binary"


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows put together to about BATCH_BYTES."""
    some: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for start, end in octets.batches(octets_of(batch), BATCH_BYTES):
            some.append(batch.slice(start, end - start))
            size += some[-1].nbytes
            if size >= BATCH_BYTES:
                yield pa.Table.from_batches(some)
                some, size = [], 0
    if some:
        yield pa.Table.from_batches(some)


def _texts(column: pa.ChunkedArray) -> pa.LargeBinaryArray:
    """Texts in valid UTF-8; null is empty."""
    texts = column.cast(pa.large_binary()).fill_null(b"").combine_chunks()
    try:
        texts.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace").encode() for t in texts.to_pylist()], pa.large_binary())
    return texts


def _tokens(schema, path: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = library(path)
    kind = own.kind if end_id <= np.iinfo(own.kind).max else np.dtype("<u4")
    total = np.zeros(0, np.int64)
    for some in _gathered(batches):
        at, ids = _buffers(own.encode_array(_texts(some.column("text"))))
        ids = ids.view(own.kind).astype(kind, copy=False)
        at = at // own.kind.itemsize
        ids = np.insert(ids, at[1:], end_id)
        at += np.arange(len(at))
        total = _sum(total, np.bincount(ids))
        coded = _binary(at * kind.itemsize, ids)
        for start in range(0, len(coded), int(BATCH_ROWS)):
            rows = coded.slice(start, int(BATCH_ROWS))
            n = len(rows)
            yield record({"id": some.column("id").slice(start, n).combine_chunks(), "width": [kind.itemsize] * n, "ids": rows, "counts": pa.nulls(n)}, schema)
    yield record({"id": [None], "width": [kind.itemsize], "ids": [None], "counts": [total.astype("<i8").tobytes()]}, schema)


def _sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    a = a.copy()
    a[: len(b)] += b
    return a


def _histogram(schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for counts in batch.column("counts").to_pylist():
            total = _sum(total, np.frombuffer(counts, "<i8"))
    used = np.flatnonzero(total)
    yield record({"token": used, "k": total[used]}, schema)


class _Writer:
    """One file, in memory until it is closed; it holds about ROLL ids, or one longer document."""

    def __init__(self, lengths: np.ndarray, codes: np.ndarray) -> None:
        self.lengths, self.codes = lengths, codes
        table = zlib.compress(lengths.tobytes(), 6)
        self.parts = [MAGIC, struct.pack("<II", len(lengths), len(table)), table]
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[int, int]] = []
        self.n = 0

    def add(self, doc: int, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc, len(ids)))
        self.n += len(ids)

    def close(self) -> bytes:
        ids = np.concatenate(self.ids)
        for start in range(0, len(ids), BLOCK):
            some = ids[start : start + BLOCK]
            bits, marks = huffman.encode(some, self.lengths, self.codes)
            body = marks.tobytes() + bits
            self.parts += [struct.pack("<IIII", len(some), len(marks), len(bits), zlib.crc32(body)), body]
        at = sum(map(len, self.parts))
        listed = zlib.compress(np.array(self.docs, "<i8").tobytes(), 6)
        self.parts += [listed, struct.pack("<QQ", at, len(self.docs)), MAGIC]
        return b"".join(self.parts)


WRITTEN = "temporary string, first_id long, docs long, ids long, bytes long"


def _write(schema, uri, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, path = open_store(uri)
    lengths, codes = shared.value

    def close(writer: _Writer) -> pa.RecordBatch:
        data, temporary = writer.close(), f"_temporary-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{path}/{temporary}") as out:
            out.write(data)
        row = {"temporary": temporary, "first_id": writer.docs[0][0], "docs": len(writer.docs), "ids": writer.n, "bytes": len(data)}
        return record({k: [v] for k, v in row.items()}, schema)

    writer = None
    for batch in batches:
        at, data = _buffers(batch.column("ids").cast(pa.large_binary()))
        at = at.tolist()
        for doc, width, start, end in zip(batch.column("id").to_pylist(), batch.column("width").to_pylist(), at[:-1], at[1:], strict=True):
            # files are runs of ascending ids, also where a task reads several pieces of the sorted table
            if writer and (writer.n >= ROLL or doc < writer.docs[-1][0]):
                yield close(writer)
                writer = None
            writer = writer or _Writer(lengths, codes)
            writer.add(doc, data[start:end].view(f"<u{width}"))
    if writer:
        yield close(writer)


def write_ids(docs: DataFrame, tokenizer: str, uri: str, end_id: int = 0) -> DataFrame:
    """Write the ids of `docs` (doc_id, text), each document closed by `end_id`, into files below `uri`.

    Returns the manifest: name, first_id, docs, ids, bytes, and start, the number of ids in the files before. Null
    text is empty; null ids are NO_ID and come first; rows of one id are written one after another. Of no rows, no
    files. `tokenizer` is a JSON file of the tokenizers library that every executor has.
    """
    spark = docs.sparkSession
    store, path = open_store(uri)
    store.create_dir(path, recursive=True)
    texts = docs.select(id_key("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    ranged = texts.repartitionByRange("id").sortWithinPartitions("id", "text")
    encoded = saved(ranged.mapInArrow(Tidy(partial(_tokens, arrow_schema(ENCODED), tokenizer, end_id)), ENCODED), "ids")
    met, ids = encoded.where("counts is not null").select("counts"), encoded.where("counts is null").drop("counts")
    counted = met.mapInArrow(Tidy(partial(_histogram, arrow_schema("token long, k long"))), "token long, k long").groupBy("token").agg(F.sum("k").alias("k"))
    counts = np.zeros(1, np.int64)
    for r in counted.collect():  # one row per id of the vocabulary
        if r["token"] >= len(counts):
            counts = np.pad(counts, (0, r["token"] + 1 - len(counts)))
        counts[r["token"]] = r["k"]
    lengths = huffman.code_lengths(counts)
    shared = spark.sparkContext.broadcast((lengths, huffman.canonical(lengths)))
    manifest = committed(ids.mapInArrow(Tidy(partial(_write, arrow_schema(WRITTEN), uri, shared)), WRITTEN), uri, ["first_id"], "ids-%06d.mwt")
    # one row per file
    order = Window.orderBy("first_id", "name").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(order), F.lit(0)))


def _parsed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A file's documents with their numbers of ids, and all its ids; a damaged block is an error."""
    if data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a token file")
    n_codes, size = struct.unpack_from("<II", data, 8)
    decode = huffman.Decoder(np.frombuffer(zlib.decompress(data[16 : 16 + size]), np.uint8, n_codes))
    listed, n_docs = struct.unpack_from("<QQ", data, len(data) - 24)
    docs = np.frombuffer(zlib.decompress(data[listed : len(data) - 24]), "<i8").reshape(n_docs, 2)
    at, blocks = 16 + size, []
    while at < listed:
        n, n_marks, n_bits, crc = struct.unpack_from("<IIII", data, at)
        body = data[at + 16 : at + 16 + 2 * n_marks + n_bits]
        if zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        blocks.append((body[2 * n_marks :], n, np.frombuffer(body, "<u2", n_marks).astype(np.int64)))
        at += 16 + len(body)
    ids = [decode.several(blocks[i : i + TOGETHER_BLOCKS]) for i in range(0, len(blocks), TOGETHER_BLOCKS)]
    return docs, np.concatenate(ids) if ids else np.zeros(0, np.uint32)


def read_file(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(document, ids) of a file's bytes, in order; a damaged block is an error."""
    docs, ids = _parsed(data)
    start = 0
    for doc, n in docs.tolist():
        yield doc, ids[start : start + n]
        start += n


def _read(schema, uri: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, path = open_store(uri)
    for batch in batches:
        for name, first in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist(), strict=True):
            with store.open_input_stream(f"{path}/{name}") as lines:
                docs, ids = _parsed(lines.read())
            at = np.append(0, np.cumsum(docs[:, 1]))
            rows = _binary(at * 4, ids.astype("<u4", copy=False))
            for start in range(0, len(docs), int(BATCH_ROWS)):
                some = slice(start, start + int(BATCH_ROWS))
                yield record({"id": docs[some, 0], "start": first + at[:-1][some], "n_tokens": docs[some, 1], "ids": rows[some]}, schema)


def read_ids(manifest: DataFrame, uri: str) -> DataFrame:
    """id, start, n_tokens, ids (little-endian 32-bit) of every document in the manifest's files."""
    schema = "id long, start long, n_tokens long, ids binary"
    return one_per_task(manifest.select("name", "start")).mapInArrow(Tidy(partial(_read, arrow_schema(schema), uri)), schema)


def token_file_report(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from files written for it and read back."""
    uri = folder(docs.sparkSession, "token-files")
    out = read_ids(write_ids(docs, tokenizer, uri, end_id), uri)
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
