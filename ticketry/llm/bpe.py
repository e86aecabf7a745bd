"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts texts into chunks, the same in every copy of a passage. A chunk
that several rows hold is encoded once, by one of them, and its ids are handed to the others. A cut
may go through a word: where chunks meet, the words at the join are encoded anew, over as many
chunks as they reach, and the ids a chunk gives up there have to agree exactly with those of its own
end; where they don't, the whole chunk is encoded again.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import cut, keyed
from ticketry.llm.tokens import Encoder, default_path, load, portions, token_texts

#: One of so many places is a cut (a power of two): the mean length of a chunk in bytes.
CHUNK = 2048
GRAM = 8
#: How far a cut looks for white space, in bytes.
NEAR = 64
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Rows that take the ids of a chunk from one copy.
HOLDERS = 1000


def chunks(data: bytes) -> list[bytes]:
    """The text in chunks; a cut depends on the bytes around it alone and lies between characters.

    It moves on to the next white space, if there is one near, and else goes through a word.
    """
    if len(data) <= GRAM:
        return [data] if data else []
    grams = np.ndarray(len(data) - GRAM + 1, "<u8", data, 0, (1,))
    mask = np.uint64((CHUNK - 1) << 40)
    cuts = np.flatnonzero(((grams * np.uint64(0x9E3779B97F4A7C15)) & mask) == 0) + GRAM
    edges = [0]
    for cut_at in cuts.tolist():
        space = SPACE.search(data, cut_at, cut_at + NEAR)
        if space:
            cut_at = space.start()
        while cut_at < len(data) and data[cut_at] & 0xC0 == 0x80:
            cut_at += 1
        if edges[-1] < cut_at < len(data):
            edges.append(cut_at)
    return [data[a:b] for a, b in zip(edges, [*edges[1:], len(data)])]


def name(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def joined(parts: list[tuple[bytes, bytes]], encode) -> bytes:
    """Ids of the whole text from (chunk, ids of the chunk) in order."""
    out, open_word = [], b""
    for data, ids in parts:
        first = SPACE.search(data)
        if first is None:  # inside one word
            open_word += data
            continue
        last = max(data.rfind(c) for c in b" \t\n\x0b\x0c\r")
        head, tail = data[: first.start()], data[last + 1 :]
        front, back = encode(head), encode(tail)
        if len(front) + len(back) <= len(ids) and ids.startswith(front) and ids.endswith(back):
            middle = ids[len(front) : len(ids) - len(back)]
        else:
            middle = encode(data[first.start() : last + 1])
        out += [encode(open_word + head), middle]
        open_word = tail
    out.append(encode(open_word))
    return b"".join(out)


def _short(ids: bytes) -> bytes:
    """Ids on their way from one row to others: 16 bits each where they fit."""
    wide = np.frombuffer(ids, "<u4")
    return b"2" + wide.astype("<u2").tobytes() if wide.max(initial=0) < 1 << 16 else b"4" + ids


def _long(sent: bytes) -> bytes:
    return sent[1:] if sent[:1] == b"4" else np.frombuffer(sent[1:], "<u2").astype("<u4").tobytes()


def _name_chunks(batches):
    for batch in batches:
        out = [[], [], []]
        rows = zip(*(batch.column(c).to_pylist() for c in ("__id", "__th", "__text")))
        for doc, th, text in rows:
            for chunk in set(map(name, chunks(text.encode()))):
                for column, value in zip(out, (doc, th, chunk)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
            ["__id", "__th", "chunk"],
        )


def _encode_owned(path: str):
    def run(batches):
        encode = Encoder(path)
        for batch in batches:
            names, times, ids = [], [], []
            rows = zip(batch.column("__text").to_pylist(), batch.column("owned").to_pylist())
            for text, owned in rows:
                wanted = {o["chunk"]: o["n"] for o in owned}
                for chunk in chunks(text.encode()):
                    n = wanted.pop(name(chunk), None)
                    if n:
                        names.append(name(chunk))
                        times.append(n)
                        ids.append(_short(encode(chunk)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(times, pa.int64()), pa.array(ids, pa.binary())],
                ["chunk", "n", "ids"],
            )

    return run


def _encode(path: str, decode: bool):
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
    names = ["__id", "__th", "ids", "decoded"]

    def run(batches):
        encode = Encoder(path)
        texts = token_texts(path)
        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in ("__id", "__th", "__text")]
            rows = zip(*lists[:2], batch.column("shared"), lists[2])
            for some in portions(rows):
                parts, new = [], []
                for doc, th, shared, data in some:
                    known = {}
                    if shared.is_valid:
                        fields = shared.values
                        sent = map(_long, fields.field("ids").to_pylist())
                        known = dict(zip(fields.field("chunk").to_pylist(), sent))
                    own = [(c, known.get(name(c)) if known else None) for c in chunks(data)]
                    parts.append((doc, th, own))
                    new += [c for c, ids in own if ids is None]
                fresh = iter(encode.all(new))
                out = [[] for _ in names]
                for doc, th, own in parts:
                    ids = joined([(c, next(fresh) if i is None else i) for c, i in own], encode)
                    decoded = None
                    if decode:
                        decoded = " ".join([texts[i] for i in np.frombuffer(ids, "<u4").tolist()])
                    for column, value in zip(out, (doc, th, ids, decoded)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, out, kinds)), names)

    return run


def encode(documents: DataFrame, path: str | None = None, decode: bool = True) -> DataFrame:
    """__id, __th, ids (binary, little-endian unsigned 32-bit) and decoded of each row.

    ``path`` is a tokenizer file whose tokens don't reach over ASCII white space and which has no
    decoder (tokens are joined by a blank); special tokens are not added. Null text is empty
    and has no ids. Equal rows get equal results; an empty table gives an empty result.
    """
    path = path or default_path()
    if load(path)[0].decoder is not None:
        raise ValueError("the tokenizer has a decoder of its own")
    key = ["__id", "__th"]
    texts = keyed(documents)
    held = texts.mapInArrow(_name_chunks, "__id long, __th long, chunk binary")
    shared = cut(
        held.groupBy("chunk").agg(F.count("*").alias("n"), F.min(F.struct(*key)).alias("owner"))
        .where("n > 1")
    )
    owners = shared.groupBy("owner.__id", "owner.__th").agg(
        F.collect_list(F.struct("chunk", "n")).alias("owned")
    )
    once = (
        texts.join(owners, key).mapInArrow(_encode_owned(path), "chunk binary, n long, ids binary")
        .dropDuplicates(["chunk"])
    )
    # A chunk that very many rows hold is handed out from several copies of its ids.
    copies = lambda n: F.ceil(n / HOLDERS)
    once = once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies(F.col("n")))))
    holders = held.join(shared.select("chunk", "n"), "chunk").withColumn(
        "copy", F.pmod(F.xxhash64(*key), copies(F.col("n"))) + 1
    )
    handed = (
        holders.drop("n").join(once.drop("n"), ["chunk", "copy"]).groupBy(*key)
        .agg(F.collect_list(F.struct("chunk", "ids")).alias("shared"))
    )
    return texts.join(handed, key, "left").mapInArrow(
        _encode(path, decode), "__id long, __th long, ids binary, decoded string"
    )
