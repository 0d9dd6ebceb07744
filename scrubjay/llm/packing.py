"""Best-fit packing of token pieces into sequences by swap-based local search.

Documents are tokenised whole; an end token is added. Only documents longer than a sequence are cut: full pieces from
the end backwards, the first piece taking the remainder. A full piece is a sequence of its own. All other pieces are
dealt at random (a hash of the id) to groups of about ``GROUP_PIECES`` pieces; each group starts from best fit by
falling length and then improves: sequences, the emptiest first, give pieces to others by moving them into gaps, by
exchanging one for one, two for one, or one for two, whatever raises the sum of squared fills most, until sequences
are empty and nothing helps. Sequences that end up less than ``LEAST_FILL`` full are dissolved and
their pieces packed once more in fewer, equally bounded groups, so that the groups' rests do not add up.

A group's size is bounded and their number grows with the input. Defined results: null and empty texts are one piece
holding the end token; repeated rows are packed each; rows with a null id are packed too; equal lengths keep the order
of id and piece; an empty table gives an empty result. The strings of special tokens are ordinary text.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, strings

SEQUENCE = 2048
END = 0
GROUP_PIECES = 4096
LEAST_FILL = 0.985
#: Pieces of a sequence that take part in exchanges, and the pairs of them.
SLOTS = 6
PAIRS = [(i, j) for i in range(SLOTS) for j in range(i + 1, SLOTS)]
#: Fixed value: the pre-token pattern of byte-level BPE vocabularies of this kind.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pre-tokens, where no two white-space characters stand together; without its look-ahead it is much faster.
PLAIN_PRE_TOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_WIDE_SPACE = re.compile(r"\s\s")
#: Runs of white space so long that the pattern's look-ahead, which steps back through them, is better not asked.
LONG_RUN = 4096


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokens:
    """Ids of texts as little-endian 32-bit bytes.

    The vocabulary of a byte-level ``tokenizer.json`` is given to tiktoken, whose merges yield the same ids several times
    faster. (A memo of the stretches between spaces was measured and saves nothing: the look-ups cost as much.)
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        letters = byte_letters()
        special = {t["content"] for t in model.get("added_tokens", ())}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items()
                 if token not in special}
        self.encoding, self.fast, self.whole = (
            tiktoken.Encoding("byte-level", pat_str=p, mergeable_ranks=ranks, special_tokens={})
            for p in (PRE_TOKEN, PLAIN_PRE_TOKEN, r"(?s).+"))
        white = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # fixed value: Unicode White_Space
        self.long_run = re.compile(f"[{white}]{{{LONG_RUN},}}")

    def plain(self, text: str) -> bytes:
        """The ids of a text.

        A run of white space is one pre-token, but for its last character if a word follows. Long runs are cut out by
        that rule and encoded as they are; what stands between them is encoded as usual, so the ids are the same.
        """
        if len(text) < LONG_RUN or not _WIDE_SPACE.search(text) or not self.long_run.search(text):
            return array("I", self._usual(text)).tobytes()
        out, at = array("I"), 0
        for run in self.long_run.finditer(text):
            end = run.end() - (run.end() < len(text))
            out.extend(self._usual(text[at:run.start()]))
            out.extend(self.whole.encode_ordinary(text[run.start():end]))
            at = end
        out.extend(self._usual(text[at:] if at else text))
        return out.tobytes()

    def _usual(self, text: str) -> list[int]:
        return (self.encoding if _WIDE_SPACE.search(text) else self.fast).encode_ordinary(text)


_TOOLS: dict[str, Tokens] = {}


def cut(length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, the first shorter if need be."""
    first = length % SEQUENCE or SEQUENCE
    return [(0, first)] + [(s, SEQUENCE) for s in range(first, length, SEQUENCE)]


_PIECE = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the ids themselves with ``keep_ids``."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _TOOLS:
            _TOOLS[tokenizer] = Tokens(tokenizer)
        tool = _TOOLS[tokenizer]
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in strings(part.column(1)).to_pylist()]
                rows, cols, ids_out = [], [[] for _ in range(4)], []
                for i, ids in enumerate(map(tool.plain, texts)):
                    ids += end
                    for n, (start, length) in enumerate(cut(len(ids) // 4)):
                        own = ids[4 * start:4 * (start + length)]
                        rows.append(i)
                        for c, v in zip(cols, (n, start, length, zlib.crc32(own))):
                            c.append(v)
                        if keep_ids:
                            ids_out.append(own)
                out = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()),
                       *(pa.array(c, pa.int64()) for c in cols[1:])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    out.append(pa.array(ids_out, pa.binary()))
                    names.append("ids")
                yield pa.record_batch(out, names=names)

    return narrow.mapInArrow(run, _PIECE.format(kind=kind) + (", ids binary" if keep_ids else ""))


class Bins:
    """Sequences under local search: which pieces each holds and how full it is."""

    def __init__(self, lengths: list[int]):
        self.lengths = lengths
        self.members: list[list[int]] = []
        self.fill: list[int] = []
        gaps: list[tuple[int, int]] = []  # (gap, sequence), sorted
        for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            need = lengths[piece]
            spot = bisect_left(gaps, (need, -1))
            if spot == len(gaps):
                self.members.append([])
                self.fill.append(0)
                at = len(self.fill) - 1
            else:
                at = gaps.pop(spot)[1]
            self.members[at].append(piece)
            self.fill[at] += need
            if self.fill[at] < SEQUENCE:
                insort(gaps, (SEQUENCE - self.fill[at], at))

    def slots(self, at: int) -> None:
        """Enters a sequence's first SLOTS pieces into the table of all sequences, which is tried before the others."""
        shown = self.members[at][:SLOTS]
        self.shown[at] = shown
        self.known.pop(at, None)
        self.size[at] = 0
        self.size[at, :len(shown)] = [self.lengths[i] for i in shown]
        self.full[at] = self.fill[at]

    def best_step(self, give: int) -> tuple[int, list[int], list[int]] | None:
        """The transfer from ``give`` that raises the sum of squared fills most: (receiver, pieces out, pieces back).

        One or two pieces go out against none, one, or (for one) two pieces back. For a net transfer d from fill g to
        fill t the sum rises by 2 d (t - g + d).
        """
        g, gap = self.full[give], SEQUENCE - self.full
        mine = self.shown[give]
        usable = self.full > 0
        usable[give] = False
        outs = [[i] for i in mine] + [[i, j] for n, i in enumerate(mine) for j in mine[n + 1:]]
        best, step = 0, None
        for out in outs:
            n = sum(self.lengths[i] for i in out)
            for kind, back in enumerate((0, self.size, self.pairs if len(out) == 1 else None)):
                if back is None:
                    continue
                d = (n - back) if kind else np.full((len(gap), 1), n)
                fits = (d > 0) & (d <= gap[:, None]) & usable[:, None]
                if kind:
                    fits &= back > 0
                gain = np.where(fits, 2 * d * (self.full[:, None] - g + d), 0)
                top = int(gain.argmax())
                take, place = divmod(top, gain.shape[1])
                if gain[take, place] > best:
                    best, step = int(gain[take, place]), (take, out, kind, place)
        if step is None:
            return None
        take, out, kind, place = step
        shown = self.shown[take]
        return take, out, [[], [shown[place]] if kind == 1 else [], [shown[i] for i in PAIRS[place]] if kind == 2 else []][kind]

    def choices(self, at: int) -> list[tuple[np.ndarray, list[list[int]]]]:
        """A sequence's single pieces and its pairs of pieces, one for each different sum, each with their sums."""
        if at not in self.known:
            left = sorted(self.members[at], key=lambda i: self.lengths[i])
            # A length that occurs twice makes a pair with itself; more of it make no new sum.
            few = [i for n, i in enumerate(left) if n < 2 or self.lengths[left[n - 2]] < self.lengths[i]]
            ones = {self.lengths[i]: [i] for i in few}
            twos = {self.lengths[i] + self.lengths[j]: [i, j] for n, i in enumerate(few) for j in few[n + 1:]}
            self.known[at] = [(np.array(list(x), np.int64), list(x.values())) for x in (ones, twos)]
        return self.known[at]

    def wide_step(self, give: int) -> tuple[int, list[int], list[int]] | None:
        """As ``best_step``, with the pieces beyond the first SLOTS, of all sequences with room; the most promising first."""
        g = int(self.full[give])
        room = np.flatnonzero((self.full > 0) & (self.full < SEQUENCE))
        wide = len(self.members[give]) > SLOTS
        room = np.array([t for t in room.tolist() if t != give and (wide or len(self.members[t]) > SLOTS)], np.int64)
        if not len(room):
            return None
        mine = self.choices(give)
        gap = SEQUENCE - self.full[room]
        most = np.minimum(gap, max(int(sums.max()) for sums, _ in mine if len(sums)))
        bound = 2 * most * (self.full[room] - g + most)
        best, step = 0, None
        for spot in np.argsort(-bound, kind="stable").tolist():
            if bound[spot] <= best:
                break
            take = int(room[spot])
            (one_sums, ones), (two_sums, twos) = self.choices(take)
            singles, doubles = np.append(0, one_sums), np.concatenate([[0], one_sums, two_sums])
            backs = [[], *ones, *twos]
            for (sums, outs), back_sums in zip(mine, (doubles, singles)):
                if not len(sums):
                    continue
                d = sums[:, None] - back_sums
                gain = np.where((d > 0) & (d <= gap[spot]), 2 * d * (int(self.full[take]) - g + d), 0)
                out, back = divmod(int(gain.argmax()), gain.shape[1])
                if gain[out, back] > best:
                    best, step = int(gain[out, back]), (take, outs[out], backs[back])
        return step

    def improve(self) -> None:
        """Steps from the emptiest sequences on, until none helps; every step raises the sum of squared fills.

        A sequence that has given all its pieces away is gone. It also ends when there are as few sequences as the
        pieces' sum allows.
        """
        fewest = -(-sum(self.lengths) // SEQUENCE)
        count = len(self.fill)
        if count <= fewest:
            return
        self.shown: list[list[int]] = [[] for _ in range(count)]
        self.known: dict[int, list[tuple[np.ndarray, list[list[int]]]]] = {}
        self.size = np.zeros((count, SLOTS), np.int64)
        self.full = np.zeros(count, np.int64)
        for at in range(count):
            self.slots(at)
        first, second = np.array(PAIRS).T
        both = (self.size[:, first] > 0) & (self.size[:, second] > 0)
        self.pairs = np.where(both, self.size[:, first] + self.size[:, second], 0)
        moved = True
        while moved:
            moved = False
            for give in np.argsort(self.full, kind="stable").tolist():
                while 0 < self.full[give] < SEQUENCE and (step := self.best_step(give) or self.wide_step(give)):
                    take, out, back = step
                    for a, b, pieces_ in ((give, take, out), (take, give, back)):
                        for piece in pieces_:
                            self.members[a].remove(piece)
                            self.members[b].append(piece)
                            self.fill[a] -= self.lengths[piece]
                            self.fill[b] += self.lengths[piece]
                    for at in (give, take):
                        self.slots(at)
                        own = self.size[at]
                        self.pairs[at] = np.where((own[first] > 0) & (own[second] > 0), own[first] + own[second], 0)
                    moved = True
                if np.count_nonzero(self.full) <= fewest:
                    return


def pack_group(lengths: list[int]) -> list[list[int]]:
    """The pieces (by index) of each sequence."""
    bins = Bins(lengths)
    bins.improve()
    return [m for m in bins.members if m]


_PACKED = "pid long, bin long, offset long, fill long"


def _pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    group = group.sort_by([("pid", "ascending")])
    ids, lengths = group["pid"].to_pylist(), group["length"].to_pylist()
    base = key[0].as_py() << 32
    cols: list[list[int]] = [[], [], [], []]
    for n, members in enumerate(pack_group(lengths)):
        full, at = sum(lengths[i] for i in members), 0
        for i in members:
            for c, v in zip(cols, (ids[i], base + n, at, full)):
                c.append(v)
            at += lengths[i]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("pid", "bin", "offset", "fill"), cols)})


def dealt(df: DataFrame, rows: int, first: int, salt: int) -> DataFrame:
    """``df`` with a group number; groups have about GROUP_PIECES rows each and their numbers start at ``first``."""
    groups = max(1, -(-rows // GROUP_PIECES))
    return df.withColumn("grp", F.pmod(F.xxhash64("pid", F.lit(salt)), F.lit(groups)) + F.lit(first))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every row of ``docs``."""
    cut_up = saved(pieces(docs, tokenizer, id_col, text_col).withColumn("pid", F.monotonically_increasing_id()),
                   "pieces")
    small = cut_up.filter(F.col("length") < SEQUENCE).select("pid", "length")
    total = small.count()
    first = saved(dealt(small, total, 0, 1).groupBy("grp").applyInArrow(_pack, _PACKED), "packed")
    groups = max(1, -(-total // GROUP_PIECES))
    weak = first.filter(F.col("fill") < int(LEAST_FILL * SEQUENCE)).select("pid").join(small, "pid")
    again = dealt(weak, weak.count(), groups, 2).groupBy("grp").applyInArrow(_pack, _PACKED)
    placed = first.filter(F.col("fill") >= int(LEAST_FILL * SEQUENCE)).unionAll(again)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    out = cut_up.filter(F.col("length") < SEQUENCE).join(placed, "pid").select(
        *columns, F.col("bin").alias("sequence_id"), "offset")
    full = cut_up.filter(F.col("length") == SEQUENCE).select(
        *columns, (-1 - F.col("pid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return out.unionAll(full)
