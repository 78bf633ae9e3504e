"""Bounded-space online packing of token sequences.

A text's ids are cut into windows of the sequence length and a rest. Whole windows are sequences. Rests
are dealt to partitions by a hash, and each partition packs them as they come, with a fixed number of
open windows: a rest goes where it leaves the least room (best fit); if it fits nowhere a new window
opens, and if the number is reached the fullest one is emitted first. What lies in windows still open at
the end of the partitions is packed again in groups of a bounded number of windows, longest rest first.

Only rows of a few numbers are shuffled and packed; token ids stay in the task that made them. A
partition's rows are sorted before packing, so a repeated task packs the same.

Defined results: a null or empty text is a document of the end token alone; repeated rows and null ids
are documents of their own; an empty table gives no rows; other columns are not looked at. No document is
cut except at multiples of the sequence length, and none is dropped.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from landgate.llm.batches import in_groups
from landgate.llm.memory import Memory
from landgate.llm.tables import stored, table

SEQUENCE = 4096
OPEN_WINDOWS = 64
END = 2
#: Open windows that one task packs again at the end.
LEFT_GROUP = 2048
#: Bytes of pieces of text between spaces, and their ids, that a worker remembers for good, and for a while.
REMEMBERED, RECENT = 120 << 20, 16 << 20
#: Letters that the tokenizer leaves as they are, or only makes small, and never splits.
LATIN = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
PLAIN = re.compile(f"([a-zA-Z{LATIN}]*)([.,!]*)")


class Encoder(Memory):
    """Ids of whole texts as little-endian 32-bit numbers, by a tokenizer that drops white space.

    Such a tokenizer (here: one that normalises character by character and splits at white space before
    it merges) gives a text the ids of its pieces between spaces one after the other, so every distinct
    piece is encoded once and remembered, up to a bound of bytes. Strings of added tokens in a text are those
    tokens, as in the library's default. Of a piece of plain letters with points or commas
    behind, the letters go straight to the tokenizer's merges, as it would not change or split them.
    """

    def __init__(self, path: str):
        super().__init__(REMEMBERED, RECENT)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {ord(c): as_bytes.pre_tokenize_str(c)[0][0] for c in LATIN}

    def __missing__(self, piece: str) -> bytes:
        plain = PLAIN.fullmatch(piece)
        if plain and plain[1]:
            letters = plain[1].lower()
            shown = letters if letters.isascii() else letters.translate(self.shown)
            ids = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
            ids += self[plain[2]] if plain[2] else b""
        else:
            ids = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        self.add(piece, ids)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        self.forget()
        ids = self.__getitem__
        return [b"".join(map(ids, text.replace("\n", " ").split(" "))) for text in texts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process."""
    return Encoder(path)


PIECE = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every text's windows and rest."""
    out = StructType.fromDDL(PIECE.format(id=docs.schema["doc_id"].dataType.simpleString()))
    arrow, tail = to_arrow_schema(out), np.array([end], "<u4").tobytes()
    width = 4 * sequence

    def run(batches):
        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for texts in in_groups(batch.column(1)):
                rows = []
                for own, doc_id in zip(encoder(tokenizer).encode(texts), ids, strict=False):
                    own += tail
                    for k in range(0, len(own), width):
                        cut = own[k : k + width]
                        rows.append((doc_id, k // 4, len(cut) // 4, zlib.crc32(cut), len(own) // 4))
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, out)


def pack(rows, sequence: int, most: int | None):
    """Give every row its window: (row, window, offset, whether the window was open at the end).

    A row's third value is its length. At most ``most`` windows are open at any time, and only their rows
    are held; a window's rows come out together, when it is full, emitted, or open at the end.
    """
    rooms: list[tuple[int, int]] = []
    held: dict[int, list] = {}
    n = 0
    for row in rows:
        length = row[2]
        at = bisect.bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, window = rooms.pop(at)
        else:
            if most is not None and len(rooms) >= most:
                fullest = rooms.pop(0)[1]
                yield from ((*r, False) for r in held.pop(fullest))
            room, window, n = sequence, n, n + 1
        held.setdefault(window, []).append((row, window, sequence - room))
        if room > length:
            bisect.insort(rooms, (room - length, window))
        else:
            yield from ((*r, False) for r in held.pop(window))
    for own in held.values():
        yield from ((*r, True) for r in own)


def _packer(sequence: int, most: int | None, schema: pa.Schema):
    """Batches of pieces in; the same rows with window, offset and open out."""

    def run(batches):
        part = TaskContext.get().partitionId() << 32
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        packing = pack(rows, sequence, most)
        while some := list(itertools.islice(packing, 10_000)):
            flat = [(*row, part + window, offset, open_) for row, window, offset, open_ in some]
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*flat, strict=True), schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def packed(
    docs: DataFrame,
    tokenizer: str,
    sequence: int = SEQUENCE,
    most: int = OPEN_WINDOWS,
    end: int = END,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece."""
    cut = stored(pieces(docs, tokenizer, sequence, end), "pack-pieces")
    names = cut.columns
    mark = F.xxhash64(*names)
    schema = StructType.fromDDL("window long, offset long, open boolean")
    schema = StructType([*cut.schema.fields, *schema.fields])
    arrow = to_arrow_schema(schema)

    rests = cut.filter(F.col("length") < sequence)
    dealt = rests.repartition(mark).sortWithinPartitions(mark, *names)
    placed = stored(dealt.mapInArrow(_packer(sequence, most, arrow), schema), "pack-windows")

    left = placed.filter("open")
    n_groups = max(1, -(-left.select("window").distinct().count() // LEFT_GROUP))
    grouped = left.repartition(n_groups, F.pmod(F.xxhash64("window"), F.lit(n_groups)))
    grouped = grouped.sortWithinPartitions(F.desc("length"), mark, *names).select(*names)
    again = grouped.mapInArrow(_packer(sequence, None, arrow), schema)

    whole = cut.filter(F.col("length") == sequence)
    whole = whole.withColumn("window", F.monotonically_increasing_id())
    whole = stored(whole.withColumn("offset", F.lit(0).cast("long")), "pack-whole")
    parts = (whole, placed.filter("NOT open"), again)
    numbered = [
        part.select(*names, (F.col("window") * 4 + k).alias("sequence_id"), "offset")
        for k, part in enumerate(parts)
    ]
    return functools.reduce(DataFrame.union, numbered)


def op9_bounded_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op9_bounded_packing": (op9_bounded_packing, None)}
