"""Best-fit packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, worker_cache, written

CAPACITY = 2048
END = 0
#: Words whose ids a worker remembers.
REMEMBERED = 700_000
#: Words that the library encodes at once.
TOGETHER = 1024
#: Fixed values of the vocabulary: how it cuts words, for text of these characters.
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\sa-z\u00df-\u00f6\u00f8-\u00ff0-9]+")
PLAIN = re.compile(r"[\t\n\r\x21-\x7e\u00c0-\u00ff]*")
#: Rows of one length and salt that are numbered by one sort.
SALT_ROWS = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers. The vocabulary drops white space and never joins over it, so
    that the ids of a text are those of its parts between spaces, and each part is encoded once. Parts of ASCII and western
    letters are cut into the vocabulary's words here; new words go to the library many at a time, and their ids are told
    apart by the tokens that end a word. Other parts are encoded one by one."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known, self.words = {}, {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, parts: list[str]) -> None:
        one = {p: p.lower() for p in parts if p.isalpha() and max(p) <= "\u00ff"}  # a word by itself
        plain = {p: WORDS.findall(p.lower()) for p in parts if p not in one and PLAIN.fullmatch(p) and "<|" not in p}
        new = list(set(one.values()).union(*plain.values()).difference(self.words))
        for at in range(0, len(new), TOGETHER):
            group = new[at : at + TOGETHER]
            (ids,) = self.encode([" ".join(group)])
            cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(cuts) != len(group):
                raise ValueError("this vocabulary does not mark where words end")
            raw = ids.tobytes()
            self.words.update(zip(group, [raw[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]))
        words, known = self.words, self.known
        known.update(zip(one, map(words.__getitem__, one.values())))
        for p, ws in plain.items():
            known[p] = b"".join([words[w] for w in ws])
        other = [p for p in parts if p not in known]
        known.update(zip(other, [x.tobytes() for x in self.encode(other)]))

    def batch(self, texts: list[str | None]) -> list[bytes]:
        parts = [t.split(" ") if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        if len(self.words) > REMEMBERED:
            self.words = {}
        self.learn([w for w in set().union(*parts) if w not in self.known])
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in parts]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids): every text's ids and the end id, cut every capacity ids. ids: little-endian
    unsigned 32-bit numbers. A null or empty text has the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
        tail = np.array([end], "<u4").tobytes()
        for b in batches:
            rows: list[tuple] = []
            for doc, ids in zip(b.column(0).to_pylist(), encoder.batch(b.column(1).to_pylist())):
                ids += tail
                rows += [(doc, i, 4 * i * capacity, ids[4 * i * capacity : 4 * (i + 1) * capacity]) for i in range((len(ids) // 4 + capacity - 1) // capacity)]
            doc, piece, start, ids = zip(*rows) if rows else ((), (), (), ())
            cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array([s // 4 for s in start], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, list[int]]], dict[int, int]]:
    """Martello and Toth's reduction on a histogram of lengths: (bins fixed, as (how many, lengths)), and what is left.

    For an item of length l, a set that fills a bin with it dominates another if the other's items can be dealt to the
    set's so that none gets more than its own length; a bin that dominates every other choice for l belongs to some best
    packing. Fixed are: l alone if nothing fits beside it; l and the largest k that fits, if k fills the bin or if no two
    others fit; l and the two k, b if no three others fit and no pair that fits has a lesser part above b.
    """
    left, fixed = {x: n for x, n in counts.items() if n}, []
    lengths = sorted(left)

    def take(how_many: int, items: list[int]) -> None:
        fixed.append((how_many, items))
        for x in items:
            left[x] -= how_many
            if not left[x]:
                del left[x]
                lengths.pop(bisect_left(lengths, x))

    def largest(room: int, used: list[int]) -> int | None:
        """The largest length of at most room, besides the items used."""
        for i in range(bisect_right(lengths, room) - 1, -1, -1):
            if left[lengths[i]] > used.count(lengths[i]):
                return lengths[i]
        return None

    def smallest(n: int, used: int) -> list[int]:
        out: list[int] = []
        for x in lengths:
            out += [x] * min(n - len(out), left[x] - (x == used))
            if len(out) == n:
                break
        return out

    def times(items: list[int]) -> int:
        return min(left[x] // items.count(x) for x in items)

    changed = True
    while changed:
        changed = False
        for l in sorted(left, reverse=True):
            while l in left:
                room = capacity - l
                k = largest(room, [l])
                if k is None:
                    take(left[l], [l])
                    changed = True
                    break
                low = smallest(3, l)
                if k == room or len(low) < 2 or low[0] + low[1] > room:
                    items = [l, k]
                elif len(low) < 3 or sum(low) > room:
                    b = largest(room - k, [l, k])
                    # The greatest lesser part of any pair that fits.
                    y = largest(room // 2, [l])
                    while y is not None and b is not None and y > b:
                        if largest(room - y, [l, y]) is not None and largest(room - y, [l, y]) >= y:
                            break
                        y = largest(y - 1, [l])
                    if b is None or (y is not None and y > b):
                        break
                    items = [l, k, b]
                else:
                    break
                take(times(items), items)
                changed = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing on a histogram: (how many bins, [(length, how many of it in each bin)]). Bins with the same
    content are one entry, so that the work depends on the lengths and not on how many items there are."""
    open_: dict[int, list[tuple[int, list]]] = {}
    rooms: list[int] = []

    def put(n: int, room: int, items: list) -> None:
        if n:
            if room not in open_:
                rooms.insert(bisect_left(rooms, room), room)
            open_.setdefault(room, []).append((n, items))

    for l in sorted(counts, reverse=True):
        n = counts[l]
        while n and (i := bisect_left(rooms, l)) < len(rooms):
            room = rooms[i]
            bins, items = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(i)
            each = room // l
            whole, rest = min(bins, n // each), 0
            put(whole, room - each * l, [*items, (l, each)])
            n -= whole * each
            if whole < bins and n < each:
                rest = 1 if n else 0
                put(rest, room - n * l, [*items, (l, n)])
                n = 0
            put(bins - whole - rest, room, items)
        if n:
            each = capacity // l
            put(n // each, capacity - each * l, [(l, each)])
            put(1 if n % each else 0, capacity - n % each * l, [(l, n % each)])
    return [x for group in open_.values() for x in group]


def plan(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Where the items of each length go, by their rank in it: from rank lo on, each sequence from first on takes `each`
    items, from offset on. At most capacity**2 entries, however many items."""
    fixed, left = reduced(counts, capacity)
    bins = [(n, [(x, items.count(x)) for x in dict.fromkeys(items)]) for n, items in fixed] + best_fit(left, capacity)
    used = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    for n, items in bins:
        offset = 0
        for x, each in items:
            rows.append((x, used[x], sequence, each, offset))
            used[x] += n * each
            offset += x * each
        sequence += n
    assert used == counts
    rows.sort()
    return dict(zip(("length", "lo", "first", "each", "offset"), np.array(rows, np.int64).reshape(-1, 5).T))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset: as few sequences of at most capacity as the method finds, without gaps.

    pieces: rows with a long length, 1 to capacity. The driver sees only how many rows each length has. Rows of a length
    are numbered within salts, so that a length of a third of all rows is sorted in many parts, in the order of their columns:
    the same rows get the same places however they are dealt out, and rows that are equal throughout are as good as each
    other. An empty table gives none.
    Columns named sequence_id or offset are replaced; other columns stay.
    """
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(x is None or not 0 < x <= capacity for x in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    table, names = plan(counts, capacity), pieces.columns
    salts = max(16, max(counts.values(), default=0) // SALT_ROWS + 1)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in ("doc_id", "piece") if c in names] or names), F.lit(salts)))
    in_salt = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = in_salt.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n")
    # By all columns, so that a task that runs again ranks its rows as before.
    ranked_by = [f"`{f.name}`" for f in pieces.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*ranked_by)).cast("long") - 1)
    ranked = ranked.join(before, ["length", "_salt"]).select(*names, (F.col("_rank") + F.col("_before")).alias("_rank"))
    far = np.int64(1) << 44
    keys = table["length"] * far + table["lo"]
    place = {c: i for i, c in enumerate(ranked.columns)}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(place[c]).to_numpy() for c in ("length", "_rank"))
            at = np.searchsorted(keys, length * far + rank, "right") - 1
            k = rank - table["lo"][at]
            seq, off = table["first"][at] + k // table["each"][at], table["offset"][at] + k % table["each"][at] * length
            yield pa.RecordBatch.from_arrays([*[b.column(place[c]) for c in names], pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(assign, f"{kinds}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """docs (doc_id, text) as packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty
    texts are one piece with the end id; rows that share a doc_id are packed each on its own; other columns are ignored."""
    pieces = token_pieces(docs, tokenizer or default_tokenizer(), capacity)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)


def query(spark, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
