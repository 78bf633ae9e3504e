"""Cutting JSON documents into the raw texts of their records, by one rule for files of every size.

A record is a balanced ``{...}`` outside of strings; brackets, commas and white space between records
are structure. So a document may be one record, records one after the other, an array of records, or
several arrays. Anything else between records (a scalar, a word) is a text of its own, which no
parser of records accepts, and so is what follows a ``{`` that nothing closes, in one text per split.
Arrays that are not closed, or closed twice, leave one text ``[`` or ``]``. No character of a record is
changed: numbers keep their tokens.

Files are read in splits, each piece of text up to the next ``{``. Whether a split starts inside a
string, and how deep, is a function of the split before; two numbers for each of the two cases tell it,
so one short row per split is enough to know where every split starts. Then every task cuts its
splits as it reads them, and only records that cross a border of splits are put together by a shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landgate.sources.blocks import stored

# States of splits are sent to all tasks up to this many splits; beyond it pieces meet them in a join.
MAX_SENT_SPLITS = 1 << 20
#: Characters between two beginnings of records that one task puts together, in a file with a fault.
MAX_SEGMENT = 64 << 20
#: Files with a fault that are named in a filter; more are found by a join.
MAX_NAMED_FILES = 1000
#: Cut texts that a task holds before it hands them on: their characters, and their number.
CUT_CHARACTERS, CUT_ROWS = 4 << 20, 10_000
#: Bytes of documents that a task cuts at once, but for a longer one.
DOCUMENT_BYTES = 8 << 20

_ESCAPE = re.compile(r"\\.", re.S)
# A "{" is never escaped, since text is cut into pieces there.
_ESCAPE_IN_PIECE = re.compile(r"\\[^{]", re.S)
_INDENT = re.compile(r"\n([ \t\r]*)\{")
_MARK = re.compile(r'\\.|["}]', re.S)
_STRUCTURE = re.compile(r"[\s,\[\]]*")
# Texts between records: quoted ones whole, others up to a comma, bracket or quote.
_OTHER = re.compile(r'"(?:[^"\\]|\\.)*"?|[^\s,\[\]"](?:[^,\[\]"]*[^\s,\[\]"])?', re.S)

_DECODER = json.JSONDecoder()
_BLANK = " \t\r\n"
_FIRST_KEY = re.compile(r'\s*("(?:[^"\\]|\\.)*")\s*:', re.S)

RECORD, FRAGMENT, OTHER, BRACKETS, FAULT, NESTED_LINES, NESTED_KEYS = range(7)


def _tail(text: str, first: bool) -> tuple[int, str]:
    """What stands before the "{" behind a piece: how far it is indented if it is the first sign of its line,
    else -1, and the last sign: "^" none yet, "{" none in the piece, ":[" the bracket of a key's array."""
    bare = text.rstrip(_BLANK)
    gap = text[len(bare) :]
    line = gap.rfind("\n")
    indent = len(gap) - line - 1 if line >= 0 else len(gap) if first and not bare else -1
    if not bare:
        return indent, "^" if first else "{"
    if bare[-1] == "[" and bare.rstrip("[" + _BLANK).endswith(":"):
        return indent, ":["
    return indent, bare[-1]


def _first_key(text: str) -> str | None:
    found = _FIRST_KEY.match(text)
    return found[1] if found else None


class Beginnings:
    """Tells the beginnings of records in a stream of pieces by what stands next to a "{"."""

    def __init__(self, indent: int, key: str | None, tail: tuple[int, str] = (-1, "^"), nested: tuple = ()):
        self.indent, self.key, self.before = indent, key, tail
        self.by_line, self.by_key = NESTED_LINES not in nested, NESTED_KEYS not in nested
        self.nested = set(nested)
        lines = [re.compile(rf"\n[ \t\r]{{{indent}}}\{{")] if indent >= 0 else []
        self.searches = lines + ([re.compile(r"\{\s*" + re.escape(key) + r"\s*:")] if key is not None else [])

    def piece(self, text: str, opened: bool, first: bool) -> bool:
        """Whether a record begins at the "{" before ``text``."""
        begins = opened and self._at(self.before, text)
        self.before = _tail(text, first)
        return begins

    def _at(self, before: tuple[int, str], text: str) -> bool:
        indent, sign = before
        line = indent >= 0 and indent == self.indent
        key = self.key is not None and sign in ("^", "[", ",", "}", ":[") and _first_key(text) == self.key
        if sign in (":", ":["):
            self.nested |= ({NESTED_LINES} if line else set()) | ({NESTED_KEYS} if key else set())
            return False
        return (line and self.by_line) or (key and self.by_key)

    def pieces(self, pieces: list[str], opened: bool, first: bool) -> list[int]:
        """The pieces before which a record begins, of several that follow each other. Looks only where the indentation
        or the key is found by one search, at what may stand at the file's start, and at what goes on from before."""
        joined = "{" + "{".join(pieces) if opened else "{".join(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
        opens = np.cumsum(lengths) - lengths if opened else np.cumsum(lengths[:-1]) - 1
        places = {int(opens[0])} if len(opens) else set()
        for found in self.searches:
            places.update(m.end() - 1 if m[0][0] == "\n" else m.start() for m in found.finditer(joined))
        numbers = np.searchsorted(opens, sorted(places)) + (0 if opened else 1)
        begins = []
        for i in numbers.tolist():
            before = _tail(pieces[i - 1], first and i == 1) if i else self.before
            if self._at(before, pieces[i]):
                begins.append(i)
        self.before = _tail(pieces[-1], first and len(pieces) == 1)
        return begins


def _closings(text: str) -> tuple[int, int, int]:
    """(closing braces outside strings, inside, quotes modulo 2) of a piece that starts outside."""
    if "\\" in text:
        text = _ESCAPE.sub("", text)
    parts = text.split('"')
    outside = "".join(parts[::2]).count("}")
    return outside, text.count("}") - outside, (len(parts) - 1) % 2


class Cutter:
    """Cuts a stream of pieces. ``inside`` and ``depth`` are the state the stream starts in; a record
    that is open then continues a record that an earlier stream began."""

    def __init__(self, inside: int = 0, depth: int = 0):
        self.inside, self.depth = inside, depth
        self.parts: list[str] = []
        self.continued = depth > 0
        self.brackets = 0

    def piece(self, text: str, opened: bool) -> Iterator[tuple[int, str]]:
        """The texts that end in a piece; ``opened`` tells whether a "{" stands before it."""
        if opened:
            if not self.inside:
                if not self.depth:
                    yield from self._others()
                self.depth += 1
            self.parts.append("{")
        if self.inside or self.depth:
            outside, within, odd = _closings(text)
            if self.inside:
                outside = within
            if outside < self.depth or (self.inside and not self.depth):
                self.parts.append(text)
                self.depth -= outside if self.depth else 0
                self.inside ^= odd
                return
        at = 0
        for mark in _MARK.finditer(text):
            if mark[0] == '"':
                self.inside ^= 1
            elif mark[0] == "}" and not self.inside and self.depth:
                self.depth -= 1
                if not self.depth:
                    self.parts.append(text[at : mark.end()])
                    at = mark.end()
                    yield (FRAGMENT if self.continued else RECORD), "".join(self.parts)
                    self.parts, self.continued = [], False
        self.parts.append(text[at:])

    def pieces(self, pieces: list[str], opened: bool) -> tuple[list[tuple[int, str]], np.ndarray]:
        """The same for several pieces that follow each other, and for each "{" before one whether it lies in a record
        or a string."""
        text = "{" + "{".join(pieces) if opened else "{".join(pieces)
        signs = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
        marked = (signs == ord('"')) | (signs == ord("{")) | (signs == ord("}"))
        if "\\" in text:
            marked[[m.end() - 1 for m in _ESCAPE_IN_PIECE.finditer(text)]] = False
        places = np.flatnonzero(marked)
        signs = signs[places]
        if not len(signs):
            self.parts.append(text)
            return [], np.zeros(0, bool)
        inside = (np.cumsum(signs == ord('"')) & 1) ^ self.inside
        opens, closes = signs == ord("{"), signs == ord("}")
        path = self.depth + np.cumsum(np.where(inside == 0, opens.astype(np.int64) - closes, 0))
        depth = path - np.minimum(np.minimum.accumulate(path), 0)
        before = np.concatenate([[self.depth], depth[:-1]])
        ends = (before > 0) & (depth == 0)
        events = np.flatnonzero(ends | (opens & (before == 0) & (depth > 0)))
        at, out = 0, []
        for place, ended in zip(places[events].tolist(), ends[events].tolist(), strict=True):
            self.parts.append(text[at : place + ended])
            at = place + ended
            if ended:
                out.append((FRAGMENT if self.continued else RECORD, "".join(self.parts)))
                self.parts, self.continued = [], False
            else:
                out += self._others()
        self.parts.append(text[at:])
        self.inside, self.depth = int(inside[-1]), int(depth[-1])
        return out, ((before > 0) | (inside > 0))[opens]

    def _others(self) -> Iterator[tuple[int, str]]:
        text = "".join(self.parts)
        self.parts = []
        if _STRUCTURE.fullmatch(text):
            self.brackets += text.count("[") - text.count("]")
            return
        bare = _OTHER.sub("", text)
        self.brackets += bare.count("[") - bare.count("]")
        for found in _OTHER.finditer(text):
            yield OTHER, found[0]

    def end(self) -> Iterator[tuple[int, str]]:
        """What is left when the stream ends: the beginning of a record, or texts between records."""
        if self.depth:
            yield FRAGMENT, "".join(self.parts)
        else:
            yield from self._others()


def cut_text(text: str) -> list[tuple[bool, str]]:
    """(whether it is a record, text) of all that one document held as a value consists of."""
    pieces = text.split("{")
    tails = [_tail(piece, i == 0) for i, piece in enumerate(pieces[:-1])]
    indent = min((i for i, _ in tails if i >= 0), default=-1)
    marks = Beginnings(indent, next(filter(None, map(_first_key, pieces[1:])), None))
    cutter, out, fault = Cutter(), [], False
    for i, piece in enumerate(pieces):
        begins = marks.piece(piece, i > 0, i == 0)
        fault = fault or (begins and (cutter.depth > 0 or bool(cutter.inside)))
        out += [(kind == RECORD, found) for kind, found in cutter.piece(piece, i > 0)]
    if not (fault or cutter.depth or cutter.inside):
        out += [(False, found) for _, found in cutter.end()]
        return out + [(False, found) for found in _unbalanced(cutter.brackets)]
    segments = Segments(Beginnings(indent, marks.key, nested=tuple(marks.nested)))
    found = [s for i, piece in enumerate(pieces) for s in segments.piece(piece, i > 0, i == 0)]
    return [(kind == RECORD, t) for segment in [*found, segments.end()] for kind, t in cut_segment(segment)]


class Segments:
    """Cuts a stream of pieces at the beginnings of records."""

    def __init__(self, marks: Beginnings):
        self.marks, self.parts = marks, []

    def piece(self, text: str, opened: bool, first: bool) -> Iterator[str]:
        if self.marks.piece(text, opened, first):
            yield "".join(self.parts)
            self.parts = []
        self.parts += ["{", text] if opened else [text]

    def pieces(self, pieces: list[str], opened: bool, first: bool) -> Iterator[str]:
        """The same for several pieces that follow each other."""
        at = 0
        for i in self.marks.pieces(pieces, opened, first):
            if i > at:
                self._add(pieces[at:i], at > 0 or opened)
            yield "".join(self.parts)
            self.parts, at = [], i
        self._add(pieces[at:], at > 0 or opened)

    def _add(self, pieces: list[str], opened: bool) -> None:
        self.parts.append("{" + "{".join(pieces) if opened else "{".join(pieces))

    def end(self) -> str:
        return "".join(self.parts)


def cut_segment(text: str) -> Iterator[tuple[int, str]]:
    """The texts between two beginnings. If more than records lies there, what follows the last record that can
    be read is one text."""
    if text.startswith("{"):
        try:
            end = _DECODER.raw_decode(text)[1]
        except (ValueError, RecursionError):
            end = 0
        if end and _STRUCTURE.fullmatch(text, end):  # one record that can be read, as most are
            yield RECORD, text[:end]
            return
    cutter, found = Cutter(), []
    for i, piece in enumerate(text.split("{")):
        found += cutter.piece(piece, i > 0)
    found += cutter.end()
    if all(kind == RECORD for kind, _ in found):
        yield from found
        return
    at = 0
    for kind, part in found:
        start = text.index(part, at)
        if kind != RECORD or not _is_json(part):
            rest = text[start:].rstrip(_BLANK + ",")
            yield OTHER, rest
            return
        yield kind, part
        at = start + len(part)


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return False
    return True


def _unbalanced(brackets: int) -> list[str]:
    return ["[" if brackets > 0 else "]"] if brackets else []


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", "{")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
    )


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, list[str], tuple]]:
    """(split, whether a "{" stands before them, pieces, further columns) of what a batch holds of a split, in the order
    of the scan."""
    last = None
    for batch in batches:
        files, blocks, values = batch.columns[:3]
        if not len(values):
            continue
        block = blocks.to_numpy()
        border = block[1:] != block[:-1]
        border |= pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(int(i) + 1 for i in np.flatnonzero(border)), len(values)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            split = (files[start].as_py(), blocks[start].as_py())
            own = tuple(c[start].as_py() for c in batch.columns[3:])
            # Joined and taken apart again, which is quicker than to ask for every value; no piece holds a "{".
            held = pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), values.slice(start, end - start))
            pieces = pc.binary_join(held, pa.scalar("{", values.type))[0].as_py().split("{")
            yield split, split == last or split[1] > 0, pieces, own
            last = split


def _depths(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Of all quotes and braces of a text that starts outside: quotes up to there modulo 2, and the step in depth."""
    if "\\" in text:
        text = _ESCAPE_IN_PIECE.sub("", text)
    signs = np.frombuffer(text.encode(), np.uint8)
    signs = signs[(signs == ord('"')) | (signs == ord("{")) | (signs == ord("}"))]
    return np.cumsum(signs == ord('"')) & 1, (signs == ord("{")).astype(np.int64) - (signs == ord("}"))


def _summaries(batches):
    """Per split and for both states of quotes it may start in: quotes at the end, and ``add``,
    ``least``, ``lowest``: a depth d becomes max(d + add, least), and falls to nothing on the way if
    d + lowest <= 0."""
    rows, marks = {}, {}
    for split, opened, pieces, _ in _runs(batches):
        states = rows.setdefault(split, [[0, 0, 0, 0], [1, 0, 0, 0]])
        mark = marks.setdefault(split, [-1, None, -1, "^"])
        joined = "{".join(pieces)
        if mark[1] is None:
            mark[1] = next(filter(None, map(_first_key, pieces if opened else pieces[1:])), None)
        found = [mark[2], *map(len, _INDENT.findall(joined))]
        if len(pieces) > 1:
            found.append(_tail(pieces[0], not opened)[0])
        mark[0] = min((n for n in (mark[0], *found) if n >= 0), default=-1)
        mark[2:] = _tail(pieces[-1], not opened and len(pieces) == 1)
        odd, steps = _depths("{" + joined if opened else joined)
        if not len(odd):
            continue
        for state in states:
            path = state[1] + np.cumsum(np.where(odd == state[0], steps, 0))
            state[0] ^= int(odd[-1])
            state[1] = int(path[-1])
            state[3] = min(state[3], int(path.min()))
            state[2] = state[1] - state[3]  # what a depth held at 0 comes to: the rise from the lowest point
    flat = [(*split, *even, *odd, *marks[split]) for split, (even, odd) in rows.items()]
    yield pa.RecordBatch.from_pylist([dict(zip(_SUMMARY_NAMES, r, strict=True)) for r in flat], schema=_SUMMARY_ARROW)


_NUMBERS = [f"{n}_{s}" for s in ("even", "odd") for n in ("inside", "add", "least", "lowest")]
_MARKS = {"indent": "long", "key": "string", "tail_indent": "long", "tail_sign": "string"}
_SUMMARY_NAMES = ["file", "block", *_NUMBERS, *_MARKS]
_SUMMARY_ARROW = pa.schema([
    ("file", pa.string()), *((n, pa.int64()) for n in ("block", *_NUMBERS)),
    *((n, pa.int64() if t == "long" else pa.string()) for n, t in _MARKS.items()),
])
_SUMMARY = "file string, block long, " + ", ".join(f"{n} long" for n in _NUMBERS)
_SUMMARY += "".join(f", {n} {t}" for n, t in _MARKS.items())


def _starts(splits):
    """The splits of one file in order, with the state each starts in, the split in which the record
    that is open at its end began, that of the record which the file leaves open, whether the file ends
    inside a string, and what tells the beginnings of its records."""
    splits = splits.sort_values("block")
    inside = depth = 0
    owner, out, tail = -1, [], (-1, "^")
    # The indentation before the first "{" of a split stands in the split before.
    indents = [i for i in [*splits["indent"], *splits["tail_indent"].iloc[:-1]] if i >= 0]
    keys = splits["key"].dropna()
    for row in splits.itertuples(index=False):
        kind = "odd" if inside else "even"
        ended = depth + getattr(row, f"lowest_{kind}") <= 0
        start = (row.file, row.block, inside, depth, owner)
        depth = max(depth + getattr(row, f"add_{kind}"), getattr(row, f"least_{kind}"))
        inside = getattr(row, f"inside_{kind}")
        if depth and (ended or owner < 0):
            owner = row.block
        elif not depth:
            owner = -1
        out.append((*start, owner, *tail))
        tail = (row.tail_indent, row.tail_sign)
    frame = type(splits)(out, columns=["file", "block", *_OWN[:6]])
    frame["left_open"], frame["left_inside"] = owner, inside
    frame["indent"], frame["key"] = min(indents, default=-1), keys.iloc[0] if len(keys) else None
    return frame


#: The state that a split starts in, and the marks of its file.
_OWN = ("inside", "depth", "owner", "owner_after", "tail_indent", "tail_sign", "indent", "key")
_START = (
    "file string, block long, inside long, depth long, owner long, owner_after long, tail_indent long, "
    "tail_sign string, left_open long, left_inside long, indent long, key string"
)
_CUT = "file string, block long, place long, kind int, owner long, text string, brackets long"
_CUT_ARROW = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("kind", pa.int32()),
    ("owner", pa.int64()), ("text", pa.string()), ("brackets", pa.int64()),
])


def _cutting(starts: dict | None):
    """Cut the splits of a task; their states come from ``starts``, or stand beside the pieces."""

    def run(batches):
        cutter, last, state, rows, place, marks, told = None, None, None, [], 0, None, set()

        def row(kind, text, owner, brackets=0):
            nonlocal place
            place += 1
            rows.append((*last, place, kind, owner, text, brackets))

        def finish():
            for kind, text in cutter.end():
                row(kind, text, state[3])
            if cutter.brackets:
                row(BRACKETS, None, None, cutter.brackets)

        for split, opened, pieces, own in _with_states(batches, starts):
            if split != last:
                if last is not None:
                    finish()
                last, state = split, own
                cutter, told = Cutter(own[0], own[1]), set()
                marks = Beginnings(own[6], own[7], (own[4], own[5]))
            begins = marks.pieces(pieces, opened, split[1] == 0 and not opened)
            found, held = cutter.pieces(pieces, opened)
            if any(held[i if opened else i - 1] for i in begins):
                marks.nested.add(FAULT)
            for kind in marks.nested - told:
                row(kind, None, None)
            told |= marks.nested
            for kind, text in found:
                row(kind, text, state[2] if kind == FRAGMENT else None)
            if len(rows) >= 10_000:
                yield _batch(rows)
                rows.clear()
        if last is not None:
            finish()
        yield _batch(rows)

    return run


def _with_states(batches, starts, others=False):
    for split, opened, pieces, own in _runs(batches):
        if starts is not None:
            own = starts.get(split)
            if own is None and others:
                continue
            if own is None:
                raise RuntimeError(f"the splits of {split[0]} have changed while it was read")
        yield split, opened, pieces, own


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_CUT_ARROW)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _CUT_ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_CUT_ARROW)


def _placed(pieces: DataFrame, starts: DataFrame, own: tuple[str, ...]) -> tuple[DataFrame, dict | None]:
    """Pieces and what is known of their splits: a dictionary for all tasks, or columns beside them."""
    if starts.count() <= MAX_SENT_SPLITS:
        return pieces, {(r.file, r.block): tuple(r[c] for c in own) for r in starts.collect()}
    numbered = pieces.withColumn("id", F.monotonically_increasing_id())
    placed = numbered.join(starts, ["file", "block"]).repartition("file", "block")
    return placed.sortWithinPartitions("file", "block", "id").select("file", "block", "value", *own), None


def cut_documents(spark: SparkSession, path: str) -> DataFrame:
    """(value, is_record): the raw text of every record of the files, and of what is no record."""
    pieces = _pieces(spark, path)
    summaries = pieces.mapInArrow(_summaries, _SUMMARY)
    starts = stored(summaries.groupBy("file").applyInPandas(_starts, _START))
    placed, known = _placed(pieces, starts, _OWN)
    cut = stored(placed.mapInArrow(_cutting(known), _CUT))
    ends = starts.filter("left_open >= 0 OR left_inside > 0").select("file")
    faults = stored(cut.filter(F.col("kind") == FAULT).select("file").union(ends).distinct())
    if faults.isEmpty():
        return _by_first_rule(cut, starts)
    again, files = _cut_again(pieces, starts, cut, faults)
    return _by_first_rule(cut.join(files, "file", "left_anti"), starts).union(again)


def _by_first_rule(cut: DataFrame, starts: DataFrame) -> DataFrame:
    done = cut.filter(F.col("kind").isin(RECORD, OTHER))
    done = done.select(F.col("text").alias("value"), (F.col("kind") == RECORD).alias("is_record"))
    parts = cut.filter(F.col("kind") == FRAGMENT)
    open_ = starts.filter("left_open >= 0").select("file", F.col("left_open").alias("owner")).distinct()

    def joined(parts: DataFrame) -> DataFrame:
        together = F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("parts")
        texts = parts.groupBy("file", "owner").agg(together)
        return texts.select(F.concat_ws("", F.col("parts.text")).alias("value"))

    crossing = joined(parts.join(open_, ["file", "owner"], "left_anti")).withColumn("is_record", F.lit(True))
    unclosed = parts.join(open_, ["file", "owner"], "left_semi").filter(F.col("block") - F.col("owner") <= 4 * MAX_SEGMENT)
    unclosed = joined(unclosed).select(F.substring("value", 1, MAX_SEGMENT).alias("value"))
    brackets = cut.filter(F.col("kind") == BRACKETS).groupBy("file").agg(F.sum("brackets").alias("n"))
    brackets = brackets.filter("n <> 0").select(F.expr("if(n > 0, '[', ']')").alias("value"))
    rest = unclosed.union(brackets).withColumn("is_record", F.lit(False))
    return done.union(crossing).union(rest)


_PART = "file string, block long, place long, last boolean, kind int, text string"
_PART_NAMES = ["file", "block", "place", "last", "kind", "text"]


def _segmenting(starts: dict | None):
    """Cut the splits of a task at the beginnings of records, and what lies between two of them into texts.
    A split's first part, place 0, goes on from an earlier split, and its last part may go on in a later one:
    these come out uncut."""

    def run(batches):
        last, segments, rows, place = None, None, [], 0

        def finish():
            rows.append((*last, place, True, None, segments.end()))

        for split, opened, pieces, own in _with_states(batches, starts, others=True):
            if split != last:
                if last is not None:
                    finish()
                last, place = split, 0
                nested = [k for k, held in ((NESTED_LINES, own[4]), (NESTED_KEYS, own[5])) if held]
                segments = Segments(Beginnings(own[2], own[3], (own[0], own[1]), tuple(nested)))
            for part in segments.pieces(pieces, opened, split[1] == 0 and not opened):
                if place:
                    rows += [(*last, place, False, kind, found) for kind, found in cut_segment(part)]
                else:
                    rows.append((*last, 0, False, None, part))
                place += 1
            if len(rows) >= 10_000:
                yield _parts(rows)
                rows = []
        if last is not None:
            finish()
        yield _parts(rows)

    return run


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.string()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_PART_NAMES)


def _cut_again(pieces: DataFrame, starts: DataFrame, cut: DataFrame, faults: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts of the files with a fault, cut at the beginnings of records, and these files."""
    nested = faults.join(cut.filter(F.col("kind").isin(NESTED_LINES, NESTED_KEYS)).select("file", "kind"), "file", "left")
    flags = [F.coalesce(F.max(F.col("kind") == k), F.lit(False)).alias(n) for k, n in ((NESTED_LINES, "lines"), (NESTED_KEYS, "keys"))]
    starts = starts.join(nested.groupBy("file").agg(*flags), "file")
    names = [r.file for r in faults.limit(MAX_NAMED_FILES + 1).collect()]
    if len(names) <= MAX_NAMED_FILES:
        pieces = pieces.filter(F.col("file").isin(names))
    else:
        pieces = pieces.join(faults, "file", "left_semi")
    placed, known = _placed(pieces, starts, ("tail_indent", "tail_sign", "indent", "key", "lines", "keys"))
    parts = stored(placed.mapInArrow(_segmenting(known), _PART))
    done = parts.filter("kind IS NOT NULL").select("file", "kind", "text")
    # Every uncut part but those at place 0 opens a segment; place 0 goes on with the last one opened before.
    uncut = parts.filter("kind IS NULL").drop("kind")
    own = F.when(F.col("last") & (F.col("place") > 0), F.col("block"))
    splits = uncut.groupBy("file", "block").agg(F.max(own).alias("opened"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.withColumn("before", F.coalesce(F.last("opened", True).over(earlier), F.lit(-1))).drop("opened")
    owner = F.when(F.col("place") > 0, F.col("block")).otherwise(F.col("before"))
    uncut = stored(uncut.join(before, ["file", "block"]).withColumn("owner", owner).drop("before"))
    sizes = uncut.groupBy("file", "owner").agg(F.sum(F.length("text")).alias("n"))
    long = sizes.filter(F.col("n") > MAX_SEGMENT).select("file").distinct()
    files = stored(faults.join(long, "file", "left_anti"))
    together = F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("parts")
    segments = uncut.join(files, "file", "left_semi").groupBy("file", "owner").agg(together)
    texts = segments.select("file", F.concat_ws("", F.col("parts.text")).alias("text"))

    def run(batches):
        for batch in batches:
            rows = [(file, kind, t) for file, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for kind, t in cut_segment(text)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["file", "kind", "text"])

    crossing = stored(texts.mapInArrow(run, "file string, kind int, text string"))
    found = done.join(files, "file", "left_semi").union(crossing)
    return found.select(F.col("text").alias("value"), (F.col("kind") == RECORD).alias("is_record")), files


def cut_column(df: DataFrame, column: str) -> DataFrame:
    """The same for documents held in a text column; a NULL text is no record, ``null``.

    A worker holds the batch of documents that Spark hands it, and of what it cuts one document and one batch.
    """
    return df.select(column).mapInArrow(_cut_batches, "value string, is_record boolean")


def _cut_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows):
        columns = [pa.array([t for _, t in rows], pa.string()), pa.array([r for r, _ in rows], pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=["value", "is_record"])

    rows, size = [], 0
    for batch in batches:
        for document in batch.column(0):
            text = document.as_py()
            for found in [(False, "null")] if text is None else cut_text(text):
                rows.append(found)
                size += len(found[1])
                if size >= CUT_CHARACTERS or len(rows) >= CUT_ROWS:
                    yield batch_of(rows)
                    rows, size = [], 0
    if rows:
        yield batch_of(rows)
