"""Packing of tokenized documents by shortest-pack-first over the histogram of lengths.

A document's ids are cut every `CONTEXT`; what is left over at its end has 1 to `CONTEXT` - 1 ids.
Only the histogram of piece lengths (at most `CONTEXT` numbers) reaches the driver.  There lengths are
placed longest first, each into the pack with the most room left that holds it, and whole groups of
equal packs are updated at once by their count.  Pieces then find their pattern by their rank among
those of their length, which comes from counts per length and cell, so that no length is one task.

Cases: null and empty texts are one piece, the closing id; repeated rows are packed one by one; ties
in rank go by doc_id, start and checksum and else to equal pieces; empty tables give no rows; other
columns are not read.
"""

import json
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from forkline.llm.bpe import PLAIN_PATTERN, byte_letters
from forkline.llm.common import strings, written

CONTEXT = 1024
CELLS = 256


class LibraryIds:
    """Ids of texts as the tokenizers library gives them for its file, as little-endian bytes.

    The file's vocabulary and pattern are run by tiktoken, which gives the same ids four times as fast.
    Its search gives up at a run of about a million blanks; such a text goes to the library itself.
    """

    def __init__(self, path):
        import tiktoken
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        byte = {c: b for b, c in byte_letters().items()}
        self.encoding = tiktoken.Encoding(
            "file", pat_str=PLAIN_PATTERN, special_tokens={t["content"]: t["id"] for t in data["added_tokens"]},
            mergeable_ranks={bytes(byte[c] for c in s): i for s, i in data["model"]["vocab"].items()})

    def of(self, text):
        try:
            ids = self.encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError as e:
            if "Regex error" not in str(e):
                raise
            ids = self.by_library(text)
        return ids.astype("<u4").tobytes()

    def by_library(self, text):
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(path, context=CONTEXT, end_id=0):
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        ids = LibraryIds(path)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), strings(pdf["text"]), strict=True):
                b = ids.of(text or "") + end
                total = len(b) // 4
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                rows += [(doc_id, at, min(context, total - at), zlib.crc32(b[4 * at:4 * (at + context)]), total)
                         for at in range(0, total, context)]
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield out.astype({"doc_id": "Int64"})
    return cut


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def shortest_pack_first(histogram, context=CONTEXT):
    """[(lengths, count)] of packs for {length: count}, every length placed, none over `context`."""
    room = {context: []} | {r: [] for r in range(context)}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        space = context
        while left:
            while space >= length and not (room[space] and space < context):
                space -= 1
            if space < length:
                room[context - length].append(((length,), left))
                break
            lengths, count = room[space].pop()
            take = min(left, count)
            if take < count:
                room[space].append((lengths, count - take))
            room[space - length].append((lengths + (length,), take))
            left -= take
    return [p for r in sorted(room) for p in room[r]]


def placements(packs):
    """Rows (length, first, past, sequence, offset): ranks first to past of a length go, in order, into
    the sequences from `sequence` on, at `offset`."""
    used, rows, sequence = {}, [], 0
    for lengths, count in packs:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            rows.append((length, first, first + count, sequence, offset))
            used[length] = first + count
            offset += length
        sequence += count
    return rows


def pack(docs, path, doc_id="doc_id", text="text", context=CONTEXT):
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    p = written(spark, d.mapInPandas(pieces(path, context), PIECE), "pieces")
    p = p.withColumn("cell", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(CELLS)).cast("int"))
    cells = p.groupBy("length", "cell").agg(F.count("*").alias("c"))
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("c").alias("n")).collect()}
    rows = placements(shortest_pack_first(histogram, context))
    plan = spark.createDataFrame(rows, "l long, first long, past long, sequence long, offset long")
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    skip = cells.select("length", "cell", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("skip"))
    inner = Window.partitionBy("length", "cell").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    # both tables are bounded by the number of lengths, not by the documents
    ranked = p.withColumn("rank", F.row_number().over(inner) - 1).join(F.broadcast(skip), ["length", "cell"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("skip"))
    return ranked.join(F.broadcast(plan), (F.col("length") == F.col("l")) & (F.col("rank") >= F.col("first"))
                       & (F.col("rank") < F.col("past"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
