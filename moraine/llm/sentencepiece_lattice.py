"""SentencePiece encoding and decoding on a relational lattice of pieces.

The pieces, a table of fixed size, are read from a model file. A text becomes a
space, the text, and its words: each space or line feed begins a word, and a
line feed ends one. Words are cut into parts where two characters meet that
stand side by side in no piece, so no piece crosses a part's ends.

``lexicon`` encodes all distinct parts of all texts in Spark: it explodes the
substrings of a part, joins them with the pieces, groups these edges by part,
and folds them with Spark's ``aggregate``. What the fold does depends on the
model. For a unigram model it is Viterbi's: the best sum of scores at each
place. The model at hand is a byte-pair one, whose own path isn't the one with
the best sum (they differ for half of the words), so its fold takes the edges
in the order of their ranks, and an edge over exactly two neighbouring symbols
joins them. The bounds of the symbols are the bits of a number.

``encode`` reads the texts once more and looks parts up with a vectorised
gather: the finished lexicon is sent to the tasks if it is small enough
(``BROADCAST_BYTES``), and otherwise joined to the texts by part.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.llm.common import setting, written
from moraine.llm.words import buffers, slices

#: The model file; an environment variable or an argument names another.
MODEL = os.environ.get("MORAINE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Longest part whose bounds, and those of edges that wait, fit one number together; and whose bounds alone do.
SHORT, LONGEST = 28, 60
#: Largest lexicon (bytes of its parts' hashes and ids) that is sent to every task.
BROADCAST_BYTES = 64_000_000
#: Parts whose edges a task groups; each has some 25, of 100 bytes.
PARTS = 5_000
#: Bytes of text that a task cuts at a time.
PIECE = 1_000_000
#: Spark's own seed of xxhash64.
SEED = 42

_MARK = "▁"
_NEVER = 1 << 30


@dataclass
class Pieces:
    """The model's table; spaces stand for the mark. ``rank``: 0 is the piece that merges first."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes: list[int]
    table: list[bytes]
    longest: int
    unigram: bool = False
    rank: dict[str, int] = field(default_factory=dict)
    runs: dict[int, list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if any(" " in s.lstrip(" ") for s in self.ids):
            raise ValueError("a piece has a space after another character, so words can't be encoded one by one")
        order = {score: k for k, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.rank = {s: order[score] for s, score in self.scores.items() if len(s) > 1}
        pairs = sorted({s[k - 1 : k + 1] for s in self.ids for k in range(1, len(s)) if s[k - 1 : k + 1] != "  "})
        chars = {c: k for k, c in enumerate(sorted({c for p in pairs for c in p}), 1)}
        self._index = np.zeros(0x110000, np.int16)
        for c, k in chars.items():
            self._index[ord(c)] = k
        self._inside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in pairs:
            self._inside[chars[a], chars[b]] = True
        self._single = np.full(0x110000, -1, np.int64)
        for s, i in self.ids.items():
            if len(s) == 1:
                self._single[ord(s)] = i
        joins = sorted((self.ids[s[:k]] << 32 | self.ids[s[k:]], self.rank[s], i) for s, i in self.ids.items() for k in range(1, len(s)) if s[:k] in self.ids and s[k:] in self.ids)
        self._pair, self._pair_rank, self._pair_id = (np.array([j[k] for j in joins] or [0], np.int64) for k in range(3))

    def merged(self, symbols: list[str]) -> list[str]:
        """What the byte-pair rule makes of symbols: the best neighbours merge, the leftmost of equals first."""
        s, rank, n = list(symbols), self.rank.get, len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = [(r, i) for i in range(n - 1) if (r := rank(s[i] + s[i + 1])) is not None]
        heapify(waiting)
        while waiting:  # by rank and place; what has changed since it was put there is passed over
            r, i = heappop(waiting)
            j = after[i]
            if s[i] is None or j == n or rank(s[i] + s[j]) != r:
                continue
            s[i], s[j], after[i] = s[i] + s[j], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := rank(s[k] + s[after[k]])) is not None:
                    heappush(waiting, (r, k))
        return [x for x in s if x is not None]

    def best(self, part: str) -> list[str]:
        """The path with the best sum of scores, the longest last piece of equals."""
        total, last = [0.0] + [-np.inf] * len(part), [0] * (len(part) + 1)
        for end in range(1, len(part) + 1):
            for begin in range(max(0, end - self.longest), end):
                score = self.scores.get(part[begin:end])
                if score is not None and total[begin] + score > total[end]:
                    total[end], last[end] = total[begin] + score, begin
        out, end = [], len(part)
        while end:
            out.append(part[last[end] : end])
            end = last[end]
        return out[::-1]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank (or ``_NEVER``) and the id of what each two symbols make."""
        pair = a << 32 | b
        at = np.minimum(np.searchsorted(self._pair, pair), len(self._pair) - 1)
        return np.where(self._pair[at] == pair, self._pair_rank[at], _NEVER), self._pair_id[at]

    def merged_alike(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``merged`` for many rows of equally many symbols: row numbers, and their ids (rows that end equally long together)."""
        rows = np.arange(len(symbols))
        rank, made = self._ranks(symbols[:, :-1], symbols[:, 1:])
        while True:
            width = symbols.shape[1]
            live = (rank < _NEVER).any(axis=1) if width > 1 else np.zeros(len(rows), bool)
            if not live.all():
                yield rows[~live], symbols[~live]
            if not live.any():
                return
            rows, symbols, rank, made = rows[live], symbols[live], rank[live], made[live]
            line, at = np.arange(len(rows)), rank.argmin(axis=1)
            new = made[line, at]
            place = np.arange(width - 1)
            symbols = np.take_along_axis(symbols, place + (place > at[:, None]), axis=1)
            symbols[line, at] = new
            if width > 2:
                later = place[:-1] + (place[:-1] >= at[:, None])
                rank, made = np.take_along_axis(rank, later, axis=1), np.take_along_axis(made, later, axis=1)
                for near in (at - 1, at):  # the pairs with what was made
                    fits = (near >= 0) & (near < width - 2)
                    k, i = line[fits], near[fits]
                    rank[k, i], made[k, i] = self._ranks(symbols[k, i], symbols[k, i + 1])

    def part(self, part: str) -> list[int]:
        """A part's ids, without Spark. A character that is no piece is a part of its own and becomes its bytes."""
        if part[0] not in self.ids:
            return [self.bytes[b] for b in part.encode("utf-8", "surrogatepass")]
        return [self.ids[s] for s in (self.best(part) if self.unigram else self.merged(list(part)))]

    def spaces(self, n: int) -> list[int]:
        """A run of spaces: whole longest pieces, then what is left."""
        if n not in self.runs:
            longest = max((len(s) for s in self.ids if not s.strip(" ")), default=1)
            whole = max(0, n - longest) // longest
            rest = " " * (n - whole * longest)
            self.runs[n] = [self.ids[" " * longest]] * whole + [self.ids[s] for s in (self.best(rest) if self.unigram else self.merged(list(rest)))]
        return self.runs[n]


def pieces(model: str = MODEL) -> Pieces:
    """The table of a model file."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as f:
        proto.ParseFromString(f.read())
    m = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    ids, scores, raw, table = {}, {}, [0] * 256, []
    for i in range(m.get_piece_size()):
        piece = m.id_to_piece(i)
        if m.is_byte(i):
            raw[int(piece[3:5], 16)] = i
            table.append(bytes([int(piece[3:5], 16)]))
        elif m.is_control(i) or m.is_unknown(i):
            table.append(b"")
        else:
            plain = piece.replace(_MARK, " ")
            ids[plain], scores[plain] = i, m.get_score(i)
            table.append(plain.encode())
    return Pieces(ids, scores, raw, table, max(map(len, ids)), unigram=proto.trainer_spec.model_type == 1)


@dataclass
class Cut:
    """Some texts in words and parts, each distinct one once."""

    #: Words of each text, and which distinct word each is.
    words: np.ndarray
    word: np.ndarray
    #: Where each distinct word's parts begin (one more entry at the end), which distinct part each is, and those parts.
    first: np.ndarray
    part: np.ndarray
    parts: pa.Array
    #: The texts' bytes, each with a space before it; an empty text has none.
    buffer: np.ndarray
    sizes: np.ndarray


def gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _strings(kind: pa.DataType, offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def cut(texts: pa.Array, table: Pieces) -> Cut:
    raw, offsets = buffers(texts)
    sizes = np.diff(offsets)
    full = sizes > 0
    begin = offsets[:-1][full]
    buffer = np.insert(raw, begin, 32)
    begin = begin + np.arange(len(begin))
    heads = (buffer == 32) | (buffer == 10)
    heads[1:] |= buffer[:-1] == 10
    heads[begin] = True
    starts = np.append(np.flatnonzero(heads), len(buffer))
    counts = np.zeros(len(sizes), np.int64)
    counts[full] = np.diff(np.append(np.searchsorted(starts, begin), len(starts) - 1))
    coded = _strings(pa.large_binary(), starts, buffer).dictionary_encode()
    dictionary = coded.dictionary
    data, ends = buffers(dictionary)
    code = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # each character's first byte
    index = table._index[code]
    alone = np.ones(len(code), bool)
    alone[1:] = ~table._inside[index[:-1], index[1:]]
    head = np.searchsorted(at, ends)
    alone[head[:-1]] = True
    where = np.flatnonzero(alone)
    pieces_ = _strings(pa.large_string(), np.append(at[where], len(data)), data).dictionary_encode()
    return Cut(counts, np.asarray(coded.indices), np.searchsorted(where, head), np.asarray(pieces_.indices), pieces_.dictionary, buffer, np.where(full, sizes + 1, 0))


def ids_of(c: Cut, table: Pieces, size: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids in a row, and how many each text has, from its distinct parts' ids."""
    start = np.cumsum(size) - size
    of_part = size[c.part]
    upto = np.concatenate([[0], np.cumsum(of_part)])
    whole = flat[gather(start[c.part], of_part)]  # the ids of each distinct word
    word_size = upto[c.first[1:]] - upto[c.first[:-1]]
    n = word_size[c.word]
    ids = whole[gather(upto[c.first[:-1]][c.word], n)]
    total = np.concatenate([[0], np.cumsum(n)])
    bounds = total[np.concatenate([[0], np.cumsum(c.words)])]
    # Spaces side by side merge after all else.
    lone = ids == table.ids[" "]
    double = np.flatnonzero(lone[1:] & lone[:-1]) + 1 if len(ids) else np.zeros(0, np.int64)
    double = double[bounds[np.searchsorted(bounds, double)] != double]
    if len(double):
        breaks = np.flatnonzero(np.diff(double) != 1)
        firsts, lasts = double[np.append(0, breaks + 1)] - 1, double[np.append(breaks, len(double) - 1)] + 1
        keep = np.ones(len(ids), bool)
        ids = ids.copy()
        for a, b in zip(firsts.tolist(), lasts.tolist()):
            new = table.spaces(b - a)
            ids[a : a + len(new)] = new
            keep[a + len(new) : b] = False
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        ids = ids[keep]
    return ids, np.diff(bounds)


Resolve = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def own_rule(table: Pieces, memory: int = 500_000) -> Resolve:
    """Distinct parts by the model's rule in the task itself, many at a time; parts that came lately are remembered."""
    known: dict[str, bytes] = {}

    def resolve(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        names = parts.to_pylist()
        if len(known) > memory:
            known.clear()
        out = [known.get(s) for s in names]
        new = [k for k, found in enumerate(out) if found is None]
        by_length: dict[int, list[int]] = {}
        for k in new:
            s = names[k]
            if table.unigram or len(s) > LONGEST or s[0] not in table.ids:
                out[k] = np.array(table.part(s), np.int32).tobytes()
            else:
                by_length.setdefault(len(s), []).append(k)
        for n, places in by_length.items():
            code = np.frombuffer("".join([names[k] for k in places]).encode("utf-32-le"), np.uint32).reshape(-1, n)
            for rows, ids in table.merged_alike(table._single[code]):
                width, raw = 4 * ids.shape[1], ids.astype(np.int32).tobytes()
                for k, row in enumerate(rows.tolist()):
                    out[places[row]] = raw[k * width : (k + 1) * width]
        known.update({names[k]: out[k] for k in new if len(names[k]) <= LONGEST})
        return np.fromiter(map(len, out), np.int64, len(out)) // 4, np.frombuffer(b"".join(out), np.int32)

    return resolve


def distinct_parts(docs: DataFrame, table: Pieces, *, text: str = "text") -> DataFrame:
    """``part``: every distinct part of at most ``LONGEST`` characters of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            parts = cut(batch.column("text"), table).parts
            yield pa.RecordBatch.from_arrays([parts.filter(pc.less_equal(pc.utf8_length(parts), LONGEST)).cast(pa.string())], names=["part"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "part string").distinct()


# The bounds of a part's symbols are the bits of a number. An edge of a part of at most SHORT characters is its order
# (rank and id) and one number with its two ends in the lower half and the bounds inside it in the upper half.
_HALF = SHORT + 2
_LOW = (1 << _HALF) - 1
_ID_BITS = 20


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k.cast("int"))


def _up(bounds: Column) -> Column:
    return F.call_function("shiftleft", bounds, F.lit(_HALF))


def _rank_fold(edges: Column, n: Column, finish: Callable[[Column], Column]) -> Column:
    """``finish`` of the bounds after one pass over the edges by rank (lower half); of -1 where an edge that had to wait may have had its turn.

    An edge whose ends are bounds joins the two symbols under it. With more
    symbols under it, it has to wait, and its inner bounds are noted in the
    upper half: if none of them goes later, it never gets its turn.
    """

    def step(state: Column, edge: Column) -> Column:
        ends = edge["mask"].bitwiseAND(F.lit(_LOW))
        inner = F.shiftright(edge["mask"], _HALF).bitwiseAND(state)
        done = (state.bitwiseAND(ends) != ends) | (inner == 0) | (state < 0)
        one = F.when(state.bitwiseAND(_up(inner)) == 0, state - inner).otherwise(F.lit(-1).cast("long"))
        return F.when(done, state).when(F.bit_count(inner) == 1, one).otherwise(state.bitwiseOR(_up(inner)))

    return F.aggregate(edges, _bit(n + 1) - 1, step, finish)


def _turns_fold(edges: Column, n: Column, finish: Callable[[Column], Column]) -> Column:
    """``finish`` of the bounds after as many turns as there can be, each of the best edge over two symbols. ``edges``: with ``ends`` and ``inner``, by rank and place."""

    def step(bounds: Column, _: Column) -> Column:
        can = F.filter(edges, lambda e: (bounds.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(bounds.bitwiseAND(e["inner"])) == 1))
        return F.when(F.size(can) == 0, bounds).otherwise(bounds - bounds.bitwiseAND(F.get(can, 0)["inner"]))

    return F.aggregate(F.when(n > 1, F.sequence(F.lit(2), n)).otherwise(F.array().cast("array<int>")), _bit(n + 1) - 1, step, finish)


def _viterbi_fold(edges: Column, n: Column, finish: Callable[[Column], Column]) -> Column:
    """``finish`` of the bounds of the path with the best sum of scores, the earliest begin of equals. ``edges``: with ``end``, ``begin`` and ``score``, in that order."""
    none = F.struct(F.lit(float("-inf")).alias("total"), F.lit(0).cast("long").alias("bounds"))
    first = F.struct(F.lit(0.0).alias("total"), F.lit(1).cast("long").alias("bounds"))
    start = F.transform(F.sequence(F.lit(0), n), lambda k: F.when(k == 0, first).otherwise(none))

    def step(paths: Column, e: Column) -> Column:
        before = F.get(paths, e["begin"])
        total = before["total"] + e["score"]
        better = F.struct(total.alias("total"), before["bounds"].bitwiseOR(_bit(e["end"])).alias("bounds"))
        return F.transform(paths, lambda p, k: F.when((k == e["end"]) & (total > p["total"]), better).otherwise(p))

    return F.aggregate(edges, start, step, lambda paths: _bound(F.element_at(paths, -1)["bounds"], finish))


def edges(parts: DataFrame, table: Pieces) -> DataFrame:
    """``part, n, begin, end, piece, rank, score``: every substring of a part (of ``n`` characters) that is a piece.

    The join is by a 64-bit hash of the substring; the substring itself is compared as well.
    """
    spark = parts.sparkSession
    known = spark.createDataFrame([(s, i, table.rank.get(s, 0), float(table.scores[s])) for s, i in table.ids.items()], "s string, piece long, rank long, score double").withColumn("hash", F.xxhash64("s"))
    n = F.length("part")
    at = parts.select("part", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("begin"))
    bounded = at.select("part", "n", "begin", F.explode(F.sequence(F.col("begin") + 1, F.least("n", F.col("begin") + table.longest))).alias("end"))
    # Never null, so that no filter computes the substring a second time.
    substring = F.coalesce(F.col("part").substr(F.col("begin") + 1, F.col("end") - F.col("begin")), F.lit(""))
    cut_out = bounded.withColumn("piece_text", substring).withColumn("hash", F.xxhash64("piece_text"))
    same = (F.col("piece_text") <= F.col("s")) & (F.col("piece_text") >= F.col("s"))
    return cut_out.join(F.broadcast(known), "hash").filter(same).select("part", "n", "begin", "end", "piece", "rank", "score")


def lexicon(parts: DataFrame, table: Pieces) -> DataFrame:
    """``part, ids`` of distinct parts of at most ``LONGEST`` characters (see the head of this file).

    A part with a character that is no piece isn't in the result.
    """
    size = F.length("part")
    out = _folded(edges(parts.filter(size <= LONGEST), table), table) if table.unigram else _ranked(edges(parts.filter(size <= SHORT), table))
    return out if table.unigram else out.unionByName(_folded(edges(parts.filter((size > SHORT) & (size <= LONGEST)), table), table))


def _ends() -> Column:
    return _bit(F.col("begin")) + _bit(F.col("end"))


def _inner() -> Column:
    return _bit(F.col("end")) - _bit(F.col("begin") + 1)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, although ``use`` has it inside other functions' arguments."""
    return F.get(F.transform(F.array(value), use), 0)


def _ranked(found: DataFrame) -> DataFrame:
    order = F.call_function("shiftleft", F.col("rank"), F.lit(_ID_BITS)) + F.col("piece")
    grouped = found.groupBy("part", "n").agg(F.collect_list(F.struct(order.alias("order"), (_up(_inner()) + _ends()).alias("mask"))).alias("edges"))

    def folded(edges: Column) -> Column:
        def on_path(bounds: Column) -> Column:
            def ids(both: Column) -> Column:
                path = F.filter(edges, lambda e: both.bitwiseAND(e["mask"]) == e["mask"].bitwiseAND(F.lit(_LOW)))
                placed = F.sort_array(F.transform(path, lambda e: F.struct(e["mask"].bitwiseAND(F.lit(_LOW)), e["order"])))
                return F.transform(placed, lambda p: p["order"].bitwiseAND(F.lit((1 << _ID_BITS) - 1)).cast("int"))

            return _bound(bounds + _up(bounds), ids)

        halves = F.transform(edges, lambda e: F.struct(e["mask"].bitwiseAND(F.lit(_LOW)).alias("ends"), F.shiftright(e["mask"], _HALF).alias("inner")))
        in_turns = _turns_fold(halves, F.col("n"), on_path)
        return _rank_fold(edges, F.col("n"), lambda s: F.when(s < 0, in_turns).otherwise(_bound(s.bitwiseAND(F.lit(_LOW)), on_path)))

    return grouped.select("part", _bound(F.sort_array("edges"), folded).alias("ids"))


def _folded(found: DataFrame, table: Pieces) -> DataFrame:
    edge = [F.col(c) for c in (("end", "begin", "score") if table.unigram else ("rank", "begin"))]
    grouped = found.groupBy("part", "n").agg(F.sort_array(F.collect_list(F.struct(*edge, _ends().alias("ends"), _inner().alias("inner"), "piece"))).alias("edges"))

    def on_path(bounds: Column) -> Column:
        path = F.filter("edges", lambda e: (bounds.bitwiseAND(e["ends"]) == e["ends"]) & (bounds.bitwiseAND(e["inner"]) == 0))
        return F.transform(F.sort_array(F.transform(path, lambda e: F.struct(e["ends"], e["piece"]))), lambda p: p["piece"].cast("int"))

    return grouped.select("part", (_viterbi_fold if table.unigram else _turns_fold)(F.col("edges"), F.col("n"), on_path).alias("ids"))


Lexicon = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _packed(rows: pa.Table) -> Lexicon:
    """Parts' hashes in order, where each one's ids start and how many there are, and all ids in a row, from ``key, ids``."""
    key, ids = np.asarray(rows.column("key").combine_chunks()), rows.column("ids").combine_chunks()
    small = np.uint16 if (pc.max(ids.flatten()).as_py() or 0) < 1 << 16 else np.int32
    size = np.asarray(pc.list_value_length(ids)).astype(np.int16)
    start = (np.cumsum(size, dtype=np.int64) - size).astype(np.uint32)
    order = np.argsort(key, kind="stable")
    return key[order], start[order], size[order], np.asarray(ids.flatten()).astype(small)


def looked_up(found: Lexicon, table: Pieces, decoder: Decoder) -> Resolve:
    """Distinct parts from a lexicon; characters that are no pieces and parts over ``LONGEST`` characters by the model's rule.

    Parts are found by hash. Ids that don't stand for the part's own bytes are another part's, and go by the rule too.
    """
    key, start, size, flat = found
    rest = own_rule(table)

    def resolve(asked: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = buffers(asked)
        own_key = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in asked.cast(pa.large_binary()).to_pylist()), np.uint64, len(asked)).view(np.int64)
        place = np.minimum(np.searchsorted(key, own_key), max(len(key) - 1, 0))
        known = np.flatnonzero(key[place] == own_key) if len(key) else np.zeros(0, np.int64)
        n = np.zeros(len(asked), np.int64)
        n[known] = size[place[known]]
        bytes_ = np.diff(offsets)[known]
        ids = flat[gather(start[place[known]].astype(np.int64), n[known])]
        same = decoder.same(ids, n[known], data[gather(offsets[known], bytes_)], bytes_)
        missing = np.ones(len(asked), bool)
        missing[known[same]] = False
        own, own_flat = rest(asked.filter(pa.array(missing)))
        ids = ids[np.repeat(same, n[known])]
        n[missing] = own
        out = np.zeros(int(n.sum()), np.int32)
        begin = np.cumsum(n) - n
        out[gather(begin[~missing], n[~missing])] = ids
        out[gather(begin[missing], own)] = own_flat
        return n, out

    return resolve


def decode(table: list[bytes], ids: list[int]) -> str:
    """The text again: what the pieces stand for, without the space put before it."""
    return b"".join([table[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


class Decoder:
    """The bytes of many texts' ids at once."""

    def __init__(self, table: list[bytes]):
        self.size = np.array([len(b) for b in table])
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(table), np.uint8)

    def same(self, ids: np.ndarray, counts: np.ndarray, buffer: np.ndarray, sizes: np.ndarray, block: int = 500_000) -> np.ndarray:
        """Whether each text's ids stand for its bytes."""
        n = self.size[ids]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        total = np.concatenate([[0], np.cumsum(n)])
        text = np.concatenate([[0], np.cumsum(sizes)])
        out = np.diff(total[bounds]) == sizes
        a = 0
        while a < len(counts):
            b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + block, "right")) - 1)
            x, y = bounds[a], bounds[b]
            if out[a:b].all():
                equal = self.bytes[gather(self.start[ids[x:y]], n[x:y])] == buffer[text[a] : text[b]]
                if not equal.all():
                    off = text[a] + np.flatnonzero(~equal)
                    out[np.searchsorted(text, off, "right") - 1] = False
            else:
                for k in range(a, b):
                    own = self.bytes[gather(self.start[ids[bounds[k] : bounds[k + 1]]], n[bounds[k] : bounds[k + 1]])]
                    out[k] = len(own) == sizes[k] and (own == buffer[text[k] : text[k + 1]]).all()
            a = b
        return out


SCHEMA = "doc_id long, n_tokens long, ids array<int>, lossless boolean"


def _encoded(batch: pa.RecordBatch, table: Pieces, decoder: Decoder, resolve: Resolve) -> pa.RecordBatch:
    c = cut(batch.column("text"), table)
    ids, counts = ids_of(c, table, *resolve(c.parts))
    same = decoder.same(ids, counts, c.buffer, c.sizes)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids.astype(np.int32)))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), lists, pa.array(same)], names=["doc_id", "n_tokens", "ids", "lossless"])


def encode(docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str = MODEL, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, n_tokens, ids, lossless`` for every row: its piece ids, and whether decoding them gives the text again.

    Null and empty texts have no ids (null is decoded as the empty text).
    Characters that are no pieces become their UTF-8 bytes. Rows keep their
    ids, null and repeated ones too; other columns, whatever their names, are
    ignored, and an empty table gives no rows. A text may have any length; a
    part of over ``LONGEST`` characters is merged by the same rule in the task.
    """
    table = pieces(model)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = written(distinct_parts(rows, table))
    # Dealt by part once, so that grouping the edges needs no shuffle, to tasks of few enough parts to group them in memory.
    tasks = max(1, -(-parts.count() // PARTS))
    with setting(docs.sparkSession, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(2 * PARTS)):
        found = written(lexicon(parts.repartition(tasks, "part"), table))
    keyed = found.select("part", F.xxhash64("part").alias("key"), "ids")
    size = found.agg(F.sum(2 * F.size("ids") + 14)).first()[0] or 0
    if size <= broadcast_bytes:
        shared = docs.sparkSession.sparkContext.broadcast((table, _packed(keyed.select("key", "ids").toArrow())))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, known = shared.value
            decoder = Decoder(own.table)
            resolve = looked_up(known, own, decoder)
            for batch in slices(batches, "text", PIECE):
                yield _encoded(batch, own, decoder, resolve)

        return rows.mapInArrow(run, SCHEMA)

    # A text asks for its own parts; equal texts ask once. What comes back to a text is bounded by the text.
    texts = rows.withColumn("asks", F.xxhash64("text"))
    lists = _asked(texts, table).join(keyed, "part").groupBy("asks").agg(F.collect_list(F.struct("key", "ids")).alias("known"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        decoder = Decoder(own.table)
        for batch in slices(batches, "text", PIECE):
            known = batch.column("known").flatten()
            # Equal parts of several texts have equal ids: the first is found.
            own_parts = _packed(pa.table({"key": known.field("key"), "ids": known.field("ids")}))
            yield _encoded(batch, own, decoder, looked_up(own_parts, own, decoder))

    return texts.join(lists, "asks", "left").select("doc_id", "text", "known").mapInArrow(look, SCHEMA)


def _asked(texts: DataFrame, table: Pieces) -> DataFrame:
    """``asks, part``: each text's distinct parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            c = cut(batch.column("text"), table)
            at = np.concatenate([[0], np.cumsum(c.words)])
            own = [np.unique(c.word[a:b]) for a, b in zip(at[:-1], at[1:])]
            own = [np.unique(c.part[gather(c.first[w], c.first[w + 1] - c.first[w])]) for w in own]
            asks = np.repeat(np.asarray(batch.column("asks")), [len(x) for x in own])
            part = c.parts.take(pa.array(np.concatenate(own))) if own else c.parts[:0]
            yield pa.RecordBatch.from_arrays([pa.array(asks, pa.int64()), part.cast(pa.string())], names=["asks", "part"])

    return texts.select("asks", "text").mapInArrow(run, "asks long, part string").distinct()


def decoded(encoded: DataFrame, *, model: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; no or null ids give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces(model).table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([decode(shared.value, i or []) for i in batch.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
