"""One document of each group of near copies, by SimHash and exact five-word similarity.

Candidates are found as in ``simhash``: fingerprints become popcounts of two-bit segments, half vectors are grid cells,
visited at distance 1, and the Manhattan distance of the popcounts bounds the Hamming distance. The fingerprints here are
of single words, two of them with seeds of their own, as near copies at a Jaccard similarity of 0.8 over five-word
shingles lie further apart in a fingerprint of shingles than a grid can search. In a cell, fingerprints of words and of
shingles are checked; what is linked makes a region. Within a region texts are taken in a fixed order, and a text goes
whose shingles have a Jaccard similarity of ``similar`` or more, worked out exactly, with one that stays.
"""

from __future__ import annotations

import math
from collections import deque
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import components, fresh, lower, raw, slices, starts, words
from larderline.llm.decontaminate import rolling
from larderline.llm.simhash import cells, unary_u64
from larderline.session import cut


@dataclass(frozen=True)
class CopyRules:
    shingle: int = 5
    similar: float = 0.8         # least Jaccard similarity of the shingles of two near copies
    seeds: tuple[int, ...] = (42, 43)
    word_bits: int = 8           # most differing bits of the fingerprints of words,
    shingle_bits: int = 14       # and of shingles, of candidates
    bitmap_bits: int = 23        # 2**bits flags of candidates go to the tasks: a fixed size, which only spares rows
    rounds: int = 2              # in which the first text of a region is compared with all others at once

    def near(self, both, m, n):
        """Whether sets of ``m`` and ``n`` shingles with ``both`` in common are similar enough (numbers or columns)."""
        return both >= self.similar * (m + n - both) - 1e-9


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words, A-Z lower-cased."""
    w = words(lower(text))
    return np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))


def mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Hashes anew under a seed."""
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each ``n`` words that follow each other, from those of the words; one of all words where there are fewer."""
    return mixed(rolling(hashes, min(n, len(hashes))), n) if len(hashes) else hashes


def print_of(hashes: np.ndarray) -> int:
    """Fingerprint (signed 64 bits): a bit is set if it is in over half of the hashes; 0 without any."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def prints(docs: DataFrame, keys: list[str], rules: CopyRules) -> DataFrame:
    """doc and ``keys`` of each row, t1 and t2 (two hashes of its words), c (fingerprint of shingles), and p, those of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for t in raw(batch, "text"):
                line, h = b" ".join(words(lower(t))), word_hashes(t)
                rows.append((xxhash.xxh64_intdigest(line, 1), xxhash.xxh64_intdigest(line, 2), print_of(shingle_hashes(h, rules.shingle)), [print_of(mixed(h, s)) for s in rules.seeds]))
            t1, t2, c, p = zip(*rows) if rows else ((),) * 4
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in ("doc", *keys)} | {"t1": signed(t1), "t2": signed(t2), "c": pa.array(c, pa.int64()), "p": pa.array(p, pa.list_(pa.int64()))})

    return docs.mapInArrow(run, "".join(f"{n} long, " for n in ("doc", *keys)) + "t1 long, t2 long, c long, p array<bigint>")


def close(p: np.ndarray, c: np.ndarray, i, j, rules: CopyRules) -> np.ndarray:
    """Which of the texts at ``j`` are candidates of those at ``i``: first by the bound, then by both fingerprints."""
    ok = np.bitwise_count(unary_u64(p[i]) ^ unary_u64(p[j])) <= rules.word_bits
    return ok & (np.bitwise_count(p[i] ^ p[j]) <= rules.word_bits) & (np.bitwise_count(c[i] ^ c[j]) <= rules.shingle_bits)


def walked(p: np.ndarray, c: np.ndarray, home: np.ndarray, rules: CopyRules) -> tuple[list[int], list[int]]:
    """Links that hold the candidates of one cell together: a walk that reaches each text once.

    A step looks at the fingerprints of shingles of all texts that aren't reached yet, in one piece of memory; those of
    unrelated texts differ in half of their bits, so the other checks see few.
    """
    a: list[int] = []
    b: list[int] = []
    open_, left, bits, shut = np.ones(len(p), bool), np.arange(len(p)), c, 0
    for seed in np.flatnonzero(home).tolist():
        if not open_[seed]:
            continue
        open_[seed], queue = False, deque([seed])
        shut += 1
        while queue:   # in order, so that the same few texts hold a crowd together in all cells
            if 8 * shut > len(left):   # reached texts leave the piece of memory now and then
                left = left[open_[left]]
                bits, shut = c[left], 0
            at = queue.popleft()
            rest = left[np.bitwise_count(bits ^ c[at]) <= rules.shingle_bits]
            rest = rest[open_[rest]]
            rest = rest[close(p, c, at, rest, rules)] if len(rest) else rest
            open_[rest] = False
            shut += len(rest)
            a += [at] * len(rest)
            b += rest.tolist()
            queue.extend(rest.tolist())
    return a, b


def regions(texts: DataFrame, rules: CopyRules) -> DataFrame:
    """(node, root): fingerprints of shingles that candidates link, but for the roots themselves. ``texts``: c, p."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            cell, p, c, home = (np.concatenate(x) for x in zip(*held))
            edge, a, b = starts(cell), [], []
            lives = np.add.reduceat(home.astype(np.int64), edge[:-1])
            for k in np.flatnonzero((np.diff(edge) > 1) & (lives > 0)):
                x, y = walked(p[edge[k]:edge[k + 1]], c[edge[k]:edge[k + 1]], home[edge[k]:edge[k + 1]], rules)
                a += (edge[k] + np.array(x, np.int64)).tolist()
                b += (edge[k] + np.array(y, np.int64)).tolist()
            return pa.RecordBatch.from_pydict({"a": c[a].view(np.int64), "b": c[b].view(np.int64)})

        for batch in batches:
            now = (batch.column("cell").to_numpy(), *(batch.column(n).to_numpy().view(np.uint64) for n in ("fp", "c")), batch.column("home").to_numpy(zero_copy_only=False))
            if not len(now[0]):
                continue
            last = starts(now[0])[-2]   # the last cell may go on in the next batch
            if last or held and held[-1][0][-1] != now[0][0]:
                held += [tuple(x[:last] for x in now)] if last else []
                yield flush()
                held = []
            held.append(tuple(x[last:] for x in now))
        if held:
            yield flush()

    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = texts.select("c", F.posexplode("p").alias("seed", "fp")).distinct().repartition(n, "c")
    grid = cells(each, ("c", "seed")).withColumn("cell", F.col("cell") * len(rules.seeds) + F.col("seed")).select("cell", "fp", "c", "home")
    # in order of the fingerprints, so that a crowd hangs on the same text in all the cells that it shares
    return components(grid.repartition(n, "cell").sortWithinPartitions("cell", "c").mapInArrow(run, "a long, b long"))


def bitmap_of(keys: DataFrame, bits: int) -> bytes:
    """Flags of the first ``bits`` bits of hashes: a fixed size, merged by 'or' in the tasks."""
    slot = F.shiftrightunsigned(F.col(keys.columns[0]), 64 - bits)
    rows = (keys.select(F.shiftright(slot, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int")).alias("flag"))
            .groupBy("at").agg(F.bit_or("flag").alias("flag")).toPandas())   # at most 2**bits / 64 rows
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["flag"].to_numpy(np.int64)
    return out.view(np.uint8).tobytes()


def majority(c: Column) -> Column:
    """The fingerprint whose bits most of a group's fingerprints have."""
    bits = [F.when(2 * F.sum(F.getbit(c, F.lit(k))) > F.count(F.lit(1)), F.shiftleft(F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long")) for k in range(64)]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


class Held:
    """The sets of the texts of a region that stay, found by their smallest hashes.

    Two near copies share 0.8 of the hashes of either at least, so the smallest hash that they share is among the first
    fifth or so of both: a new text is compared with those texts only that share one of these.
    """

    def __init__(self, rules: CopyRules):
        self.rules = rules
        self.sets: list[np.ndarray] = []
        self.having: dict[int, list[int]] = {}

    def takes(self, found: np.ndarray) -> bool:
        """Whether a text, of whose set ``found`` are the sorted hashes, has no near copy here; it is held then."""
        first = found[:len(found) - max(math.ceil(self.rules.similar * len(found) - 1e-6), 1) + 1].tolist() or [None]
        seen: set[int] = set()
        for x in first:
            for k in self.having.get(x, ()):
                if k in seen:
                    continue
                seen.add(k)
                other, m = self.sets[k], len(found)
                if self.rules.near(min(m, len(other)), m, len(other)) and self.rules.near(shared(found, other), m, len(other)):
                    return False
        for x in first:
            self.having.setdefault(x, []).append(len(self.sets))
        self.sets.append(found.copy())
        return True


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of different values have in common."""
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def kept_of(members: DataFrame, rules: CopyRules) -> DataFrame:
    """k1, k2 of the texts that stay, of ``members``: root, at (their order in the region), k1, k2, set.

    In each round the first text of a region stays, and those near it go; a crowd around one text is settled by that.
    The rest passes in order, a region at a time, and only the texts that stay are held (``Held``).
    """
    order = ["at", "k1", "k2"]
    kept = None
    for _ in range(rules.rounds):
        first = members.groupBy("root").agg(F.min(F.struct(*order)).alias("f"))
        lead = members.join(first, "root").filter(F.struct(*order) == F.col("f")).select("root", F.col("set").alias("lead"), F.col("k1").alias("l1"), F.col("k2").alias("l2"))
        lead = cut(lead)
        kept = lead.select(F.col("l1").alias("k1"), F.col("l2").alias("k2")) if kept is None else kept.union(lead.select("l1", "l2"))
        both = F.size(F.array_intersect("set", "lead"))
        rest = members.join(lead, "root").filter(~((F.col("k1") == F.col("l1")) & (F.col("k2") == F.col("l2"))) & ~rules.near(both, F.size("set"), F.size("lead")))
        members = cut(rest.select("root", *order, "set"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Held(rules)
        for batch in batches:
            out, sets = [], batch.column("set")
            for k, root in enumerate(batch.column("root").to_pylist()):
                if root != now:
                    now, held = root, Held(rules)
                if held.takes(sets[k].values.to_numpy()):
                    out.append(k)
            yield batch.select(["k1", "k2"]).take(pa.array(out, pa.int64()))

    last = members.repartition("root").sortWithinPartitions("root", *order).select("root", "set", "k1", "k2").mapInArrow(run, "k1 long, k2 long")
    return last if kept is None else kept.union(last)


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: CopyRules = CopyRules()) -> DataFrame:
    """``docs`` without near copies: no two candidates that stay are near copies, and what goes is a copy, or a near copy of one that stays.

    Texts with the same words are copies, whatever the blanks between them; of these the smallest id stays. A text of
    fewer words than a shingle has copies only. In a region, texts come in order of their distance from what most of them
    have in common, then of their ids. Null, empty and blank texts are copies of each other. A row is told by two hashes of
    its id and text; of rows that repeat both, one stays. A null id comes after all others. Other columns pass as they
    are, whatever their names. An empty table gives an empty result.
    """
    k1, k2 = fresh(docs, "_k1"), fresh(docs, "_k2")
    keyed = docs.withColumns({k1: F.xxhash64(F.col(doc_id), F.col(text)), k2: F.xxhash64(F.col(text), F.lit("second"), F.col(doc_id))})
    slim = keyed.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"), F.col(k1).alias("k1"), F.col(k2).alias("k2"))
    rows = prints(slim, ["k1", "k2"], rules)
    best = F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "k1", "k2", "c", "p")).alias("r")
    texts = cut(rows.groupBy("t1", "t2").agg(best).select("r.*"))
    root = regions(texts.select("c", "p"), rules)
    told = texts.drop("p").join(root, F.col("c") == F.col("node"), "left").withColumn("root", F.coalesce("root", "c")).drop("node")
    shared = told.groupBy("root").agg(F.count(F.lit(1)).alias("n"), majority(F.col("c")).alias("most")).filter("n > 1")
    told = cut(told.join(shared, "root", "left"))
    at = F.struct(F.bit_count(F.col("c").bitwiseXOR(F.col("most"))).alias("d"), "last", "doc")
    members = told.filter("n > 1").select("root", at.alias("at"), "k1", "k2")

    flags = docs.sparkSession.sparkContext.broadcast(bitmap_of(members.select("k1"), rules.bitmap_bits))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flag = np.frombuffer(flags.value, np.uint8)
        for batch in slices(batches):
            slot = batch.column("k1").to_numpy().view(np.uint64) >> np.uint64(64 - rules.bitmap_bits)
            part = batch.take(pa.array(np.flatnonzero(flag[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)))
            found = [np.unique(shingle_hashes(word_hashes(t), rules.shingle).view(np.int64)) for t in raw(part, "text")]
            yield pa.RecordBatch.from_pydict({"k1": part.column("k1"), "k2": part.column("k2"), "set": pa.array(found, pa.list_(pa.int64()))})

    # texts aren't shuffled for their sets: rows whose flag isn't set have none, and the join leaves the members'
    whole = slim.select("k1", "k2", "text").mapInArrow(sets, "k1 long, k2 long, set array<bigint>")
    members = cut(members.join(whole, ["k1", "k2"]).dropDuplicates(["k1", "k2"]))
    kept = told.filter("n is null").select("k1", "k2").union(kept_of(members, rules)).toDF(k1, k2)
    return keyed.join(kept, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*docs.columns)
