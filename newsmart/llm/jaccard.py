"""N-gram Jaccard join: documents that share three quarters of their word shingles.

A document's set are its distinct 5-word shingles, in lower case (A-Z only); one
of fewer words is a single shingle, one without words is empty and linked with
nothing.  Two documents link when ``100 * shared >= 75 * union``, and the result gives
each document the smallest id that links reach.

Equal sets are one class; only classes are compared.  The join is size-aware:

* Light: for two small sets of n and m shingles the rule fixes how many they must
  share, c.  Both enumerate their subsets of c shingles under (n, m); sets with a common
  subset link, nothing is left to verify, and each list is a star.
* Heavy: lists are inverted over the rarest shingles of each set, as many as a set
  can lack and still link, so any two that link meet in a list.  Sets that meet,
  directly or through others, form a candidate group, and in it the lists are
  scanned and shared shingles counted exactly.
* The boundary is the size up to which enumerating costs less than scanning, by
  the number of classes of each size.

Rarity needs each shingle's number of classes.  Hashes are exchanged once in
sorted blocks of bytes by range; shingles of a single class, most of them, end
there, and a set that holds too many of them is out.  No pair is written: a list is
joined to its head, and a group of more than ``BLOCK`` classes is compared in pairs of
blocks, each returning links that join parts, at most one for each of its classes.

Shingles are 64-bit hashes and sets 128-bit ones.  Null text is empty, rows of the
same id and text are alike, null ids take part and are only the smallest where
there is no other, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from newsmart.llm.common import bloom_of, stored, text_of
from newsmart.llm.components import components
from newsmart.llm.words import hashes, mix, window_hashes

WORDS = 5
#: Least similarity in hundredths.
LIMIT = 75
#: Largest set that may be enumerated.
LIGHT_MAX = 16
#: Cost of scanning a set per shingle, in enumerated subsets.
SCAN_COST = 4
#: Shingles that a task sorts before it sends them, shingles of a range, sets ranked at a
#: time, and sets compared at a time.
SENT = 1_000_000
SORTED = 3_000_000
PART = 16_384
BLOCK = 1024


def shingles(text: object, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes."""
    words = hashes(text_of(text).encode().lower())
    return np.unique(window_hashes(words, min(k, max(len(words), 1))))


def fingerprint(own: np.ndarray) -> tuple[int, int]:
    a, b = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), "<i8")
    return int(a), int(b)


def least_shared(n: int, m: int) -> int:
    """Fewest common shingles with which sets of n and m link."""
    return -(-LIMIT * (n + m) // (100 + LIMIT))


def partners(n: int, most: int) -> list[int]:
    """Sizes up to ``most`` that a set of n can link with."""
    return [m for m in range(1, most + 1) if least_shared(n, m) <= min(n, m)]


def subsets(n: int, most: int) -> int:
    return sum(comb(n, least_shared(n, m)) for m in partners(n, most))


def boundary(sizes: dict[int, int]) -> int:
    """The size up to which sets are enumerated, by the number of sets of each size."""

    def cost(most: int) -> int:
        light = sum(count * subsets(n, most) for n, count in sizes.items() if n <= most)
        heavy = sum(count * n * SCAN_COST for n, count in sizes.items() if meets_heavy(n, most))
        return light + heavy

    return min(range(LIGHT_MAX + 1), key=lambda most: (cost(most), most))


def meets_heavy(n: int, most: int) -> bool:
    """Whether a set of n can link with one beyond the boundary, or is beyond it."""
    return n > most or 100 * n >= LIMIT * (most + 1)


# --- sets and classes ---------------------------------------------------------


def sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n, key (a, b) of the set, and the shingles of a small one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                own = shingles(text)
                small = own.view(np.int64) if 0 < len(own) <= LIGHT_MAX else None
                rows.append((len(own), *fingerprint(own), small))
            out = pd.DataFrame(rows, columns=["n", "a", "b", "small"])
            out.insert(0, "doc_id", pd.array(batch["doc_id"], dtype="Int64"))
            out.insert(1, "text_hash", batch["text_hash"].to_numpy())
            yield out

    return _texts(docs).mapInPandas(
        run, "doc_id long, text_hash long, n long, a long, b long, small array<long>"
    ).select("doc_id", "text_hash", "n", F.struct("a", "b").alias("key"), "small")


def _texts(docs: DataFrame) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def classes(own: DataFrame) -> DataFrame:
    """key, n, its first row (doc_id, text_hash), small: one row per distinct set."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    return (
        own.where("n > 0")
        .groupBy("key", "n")
        .agg(first, F.first("small").alias("small"))
        .select("key", "n", "first.doc_id", "first.text_hash", "small")
    )


# --- light sets ---------------------------------------------------------------


def light_links(listed: DataFrame, most: int) -> DataFrame:
    """u, v: links between classes of at most ``most`` shingles, by common subsets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, subs, sides = [], [], []
            for key, n, small in zip(batch["key"], batch["n"], batch["small"], strict=True):
                own = np.asarray(small, np.int64).view(np.uint64)
                for m in partners(int(n), most):
                    share = least_shared(int(n), m)
                    h = mix(np.array([own[list(c)] for c in combinations(range(len(own)), share)], np.uint64))
                    lo, hi = min(n, m), max(n, m)
                    h = mix(h.sum(axis=1, dtype=np.uint64) + np.uint64(lo * 64 + hi))
                    keys += [key] * len(h)
                    subs.append(h.view(np.int64))
                    sides += [0 if lo == hi else 1 if n == lo else 2] * len(h)
            yield pd.DataFrame(
                {
                    "a": [k["a"] for k in keys],
                    "b": [k["b"] for k in keys],
                    "subset": np.concatenate(subs) if subs else [],
                    "side": sides,
                }
            )

    rows = (
        listed.where(F.col("n") <= most)
        .select("key", "n", "small")
        .mapInPandas(run, "a long, b long, subset long, side int")
        .select(F.struct("a", "b").alias("key"), "subset", "side")
    )
    # Sides of one size meet each other (0); of two sizes each meets the other (1 and 2).
    heads = rows.groupBy("subset").agg(
        F.count("*").alias("n"),
        *[F.min(F.when(F.col("side") == s, F.col("key"))).alias(f"head{s}") for s in (0, 1, 2)],
    )
    heads = heads.where("n > 1").drop("n")
    side = F.col("side")
    head = F.when(side == 0, F.col("head0")).when(side == 1, F.col("head2")).otherwise(F.col("head1"))
    return rows.join(heads, "subset").select(F.col("key").alias("u"), head.alias("v")).where("v is not null")


# --- heavy sets ---------------------------------------------------------------


def _planes(values: np.ndarray) -> bytes:
    """Bytes by place: the equal leading bytes of sorted values then compress well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


_HEADER = np.dtype([("a", "<i8"), ("b", "<i8"), ("n", "<i4")])


def _blocks(docs: DataFrame, ranges: int, most: int) -> DataFrame:
    """Shingles of classes in sorted blocks by range of hash: hashes, owners, and who they are."""

    def flush(parts: list[np.ndarray], header: list[tuple]) -> Iterator[pd.DataFrame]:
        if not parts:
            return
        h = np.concatenate(parts)
        owner = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p) for p in parts])
        order = np.argsort(h, kind="stable")
        h, owner = h[order], owner[order]
        who = np.array(header, _HEADER)
        at = (h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(at)) + 1
        rows = []
        for low, high in zip([0, *cuts], [*cuts, len(h)], strict=True):
            held, place = np.unique(owner[low:high], return_inverse=True)
            rows.append((int(at[low]), _planes(h[low:high]), _planes(place.astype(np.uint32)), who[held].tobytes()))
        yield pd.DataFrame(rows, columns=["range", "hashes", "owners", "header"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        parts, header, held = [], [], 0
        for batch in batches:
            for text in batch["text"]:
                own = shingles(text)
                if not len(own) or not meets_heavy(len(own), most):
                    continue
                if (key := fingerprint(own)) in seen:  # copies in this task
                    continue
                seen.add(key)
                parts.append(own)
                header.append((*key, len(own)))
                held += len(own)
                if held >= SENT:
                    yield from flush(parts, header)
                    parts, header, held = [], [], 0
        yield from flush(parts, header)

    return _texts(docs).select("text").mapInPandas(run, "range long, hashes binary, owners binary, header binary")


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one range: per class its shingles that another class holds too, with their counts."""
    header = np.concatenate([np.frombuffer(x, _HEADER) for x in rows["header"]])
    who, number = np.unique(header, return_inverse=True)
    sizes = np.array([len(x) // _HEADER.itemsize for x in rows["header"]])
    first = np.cumsum(sizes) - sizes
    h = np.concatenate([_from_planes(x, np.uint64) for x in rows["hashes"]])
    owner = np.concatenate(
        [number[_from_planes(x, np.uint32) + start] for x, start in zip(rows["owners"], first, strict=True)]
    )
    order = np.argsort(h, kind="stable")  # blocks are sorted, so this merges
    h, owner = h[order], owner[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[1:] == h[:-1]
    twice = same[1:] | same[:-1]
    h, owner = h[twice], owner[twice]
    order = np.lexsort((owner, h))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[fresh], owner[fresh]  # a class that several tasks sent counts once
    if len(h):
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        counts = np.diff(np.append(starts, len(h)))
        counts = np.repeat(counts, counts)
        h, owner, counts = h[counts > 1], owner[counts > 1], counts[counts > 1]
    part = who["a"].view(np.uint64) % np.uint64(rows["parts"].iloc[0])
    order = np.lexsort((owner, part[owner]))
    h, owner, counts = h[order], owner[order], counts[order]
    out = []
    for low, high in _runs(part[owner]):
        held, sizes = np.unique(owner[low:high], return_counts=True)
        blobs = (who[held].tobytes(), sizes.tobytes(), h[low:high].tobytes(), counts[low:high].astype(np.int32).tobytes())
        out.append((int(part[owner[low]]), *blobs))
    return pd.DataFrame(out, columns=["part", "header", "sizes", "hashes", "counts"])


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    cuts = np.flatnonzero(np.diff(values)) + 1 if len(values) else []
    return zip([0, *cuts], [*cuts, len(values)], strict=True) if len(values) else iter(())


def _rarest(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one part of the classes: the shared shingles in which each can meet others.

    A set may lack n - ceil(0.75 n) shingles; with so many of its own alone it is out.
    """
    header = np.concatenate([np.frombuffer(x, _HEADER) for x in rows["header"]])
    who, number = np.unique(header, return_inverse=True)
    owner = np.repeat(number, np.concatenate([np.frombuffer(x, np.int64) for x in rows["sizes"]]))
    h = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["hashes"]])
    counts = np.concatenate([np.frombuffer(x, np.int32) for x in rows["counts"]])
    order = np.lexsort((h, counts, owner))
    h, owner = h[order], owner[order]
    held = np.bincount(owner, minlength=len(who))
    rank = np.arange(len(owner)) - (np.cumsum(held) - held)[owner]
    n = who["n"].astype(np.int64)
    lack = n + (-LIMIT * n) // 100 + 1
    taken = np.maximum(lack - (n - held), 0)
    keep = rank < taken[owner]
    mine = who[owner[keep]]
    return pd.DataFrame({"a": mine["a"], "b": mine["b"], "shingle": h[keep].view(np.int64)})


def inverted(docs: DataFrame, total: int, sets_: int, most: int) -> DataFrame:
    """shingle, key: the lists of rarest shingles in which heavy sets can meet."""
    ranges, parts = max(1, -(-total // SORTED)), max(1, -(-sets_ // PART))
    return (
        _blocks(docs, ranges, most)
        .withColumn("parts", F.lit(parts))
        .groupBy("range")
        .applyInPandas(_shared, "part long, header binary, sizes binary, hashes binary, counts binary")
        .groupBy("part")
        .applyInPandas(_rarest, "a long, b long, shingle long")
        .select("shingle", F.struct("a", "b").alias("key"))
    )


def _scan(group: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links between sets, as many as join parts of the group: counts along the lists."""
    sizes = np.array([len(s) for s in group])
    _, ids = np.unique(np.concatenate(group), return_inverse=True)
    owner = np.repeat(np.arange(len(group)), sizes)
    order = np.argsort(ids, kind="stable")
    lists = owner[order]
    ends = np.cumsum(np.bincount(ids))
    starts = np.concatenate([[0], ends[:-1]])
    first = np.cumsum(sizes) - sizes
    part = np.arange(len(group))
    for i in range(len(group)):
        if (part == part[0]).all():
            return
        own = ids[first[i] : first[i] + sizes[i]]
        own = own[ends[own] - starts[own] > 1]
        if not len(own):
            continue
        length = ends[own] - starts[own]
        at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(starts[own], length)
        shared = np.bincount(lists[at], minlength=len(group))
        linked = np.flatnonzero(100 * shared >= LIMIT * (sizes + sizes[i] - shared))
        for p in np.unique(part[linked]):
            if p != part[i]:
                yield i, int(linked[part[linked] == p][0])
                part[part == p] = part[i]


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Links within every group of a task."""
    out = []
    for _, group in rows.groupby("grp"):
        own: dict[tuple[int, int], np.ndarray] = {}
        for a, b, text in zip(group["a"], group["b"], group["text"], strict=True):
            found = shingles(text)
            if (int(a), int(b)) == fingerprint(found):
                own[int(a), int(b)] = found
        keys = sorted(own)
        if len(keys) > 1:
            out += [(*keys[i], *keys[j]) for i, j in _scan([own[k] for k in keys])]
    return pd.DataFrame(out, columns=["a", "b", "c", "d"])


def heavy_links(docs: DataFrame, listed: DataFrame, lists: DataFrame) -> DataFrame:
    """u, v: links between classes that meet in ``lists``."""
    heads = lists.groupBy("shingle").agg(F.min("key").alias("head"), F.count("*").alias("n")).where("n > 1")
    met = lists.join(heads, "shingle").where("key != head").select(F.col("key").alias("u"), F.col("head").alias("v"))
    groups = components(met)
    members = stored(
        groups.join(listed, groups["id"] == listed["key"]).select("key", "root", "doc_id", "text_hash"), "jaccard-members"
    )
    # Dealt by hash, so that no task holds a whole group.
    blocks = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    few = F.col("blocks") == 1
    bins = max(1, -(-members.count() // BLOCK))
    placed = (
        members.join(blocks, "root")
        .withColumn("i", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("grp", F.concat_ws("/", F.col("root.a"), F.col("root.b"), F.least("i", "j"), F.greatest("i", "j")))
        .withColumn("task", F.when(few, F.pmod(F.xxhash64("root"), F.lit(bins)).cast("string")).otherwise(F.col("grp")))
        .select("key.a", "key.b", "grp", "task", "doc_id", "text_hash")
    )
    # A pair of a block with itself is part of its pair with any other.
    wanted = bloom_of(members, "text_hash")
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def maybe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[shared.value.holds(batch["text_hash"].to_numpy(np.int64))].copy()
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            yield out

    texts = _texts(docs).mapInPandas(maybe, "doc_id long, text_hash long, text string")
    rows = placed.withColumnRenamed("doc_id", "first_id").join(texts, "text_hash")
    return (
        rows.where(F.col("first_id").eqNullSafe(F.col("doc_id")))
        .select("a", "b", "grp", "task", "text")
        .groupBy("task")
        .applyInPandas(_compare, "a long, b long, c long, d long")
        .select(F.struct("a", "b").alias("u"), F.struct(F.col("c").alias("a"), F.col("d").alias("b")).alias("v"))
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    return _placed(docs).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _placed(docs: DataFrame) -> DataFrame:
    """The rows of ``sets`` with component_id and ``root``, which names a component that has no id."""
    own = stored(sets(docs), "jaccard-sets")
    listed = stored(classes(own), "jaccard-classes")
    sizes = {r["n"]: r["count"] for r in listed.where(F.col("n") <= LIGHT_MAX).groupBy("n").count().collect()}
    most = boundary(sizes)
    total, n_sets = listed.agg(F.sum("n"), F.count("*")).first()
    links = heavy_links(docs, listed, stored(inverted(docs, total or 0, n_sets, most), "jaccard-lists"))
    if most:
        links = links.union(light_links(listed, most))
    found = components(links)
    firsts = found.join(listed, found["id"] == listed["key"]).groupBy("root").agg(F.min("doc_id").alias("least"))
    named = found.join(firsts, "root").select(F.col("id").alias("key"), "least", "root")
    reps = listed.select("key", F.col("doc_id").alias("first_id")).join(named, "key", "left")
    chosen = reps.select("key", F.coalesce("least", "first_id").alias("component_id"), F.coalesce("root", "key").alias("root"))
    return own.join(stored(chosen, "jaccard-components"), "key", "left")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, of the smallest id; all columns and rows without words stay."""
    named = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text_hash")
    key = F.xxhash64(
        docs["doc_id"].cast("long"), docs["doc_id"].isNull(), F.xxhash64(docs["text"].cast("string"))
    )
    own = _placed(docs).where("n > 0")
    rows = stored(own.select(named.alias("row"), "root", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("least")), "rows")
    # Several rows share the least id only where ids are null or repeat.
    several = (
        rows.where("least")
        .groupBy("root")
        .agg(F.min("row").alias("first"), F.count("*").alias("n_rows"))
        .where("n_rows > 1")
    )
    several = stored(several, "several-rows")
    others = rows.where("least").join(several, "root").where(F.col("row") != F.col("first"))
    copies = rows.where("not least").select("row").union(others.select("row"))
    copies = stored(copies.select(F.col("row").alias("_copy")).distinct(), "copies")
    kept = docs.join(copies, key == copies["_copy"], "left_anti")
    if not several.head(1):
        return kept
    again = several.select(F.col("first").alias("_first"))
    alike = Window.partitionBy("_first").orderBy(F.xxhash64(*(docs[c] for c in docs.columns)))
    once = (
        kept.join(again, key == again["_first"])
        .withColumn("_nth", F.row_number().over(alike))
        .where("_nth = 1")
        .drop("_first", "_nth")
    )
    return kept.join(again, key == again["_first"], "left_anti").union(once)
