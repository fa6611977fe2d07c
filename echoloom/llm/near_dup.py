"""MinHash near-duplicates by a multi-index Hamming join.

1. A document's set of word shingles is hashed; equal sets form a class, which is one node from
   here on, so that thousands of exact copies cost one node.
2. A class gets a signature of SYMBOLS b-bit MinHash values.  Two signatures' distance is the
   number of differing symbols.  The signature is split into CHUNKS; by the pigeonhole principle
   two signatures at a distance of at most ``CHUNKS * (ERRORS + 1) - 1`` have a chunk that differs
   in at most ERRORS = 1 symbols.  Those errors are enumerated by leaving out each symbol of a
   chunk in turn, which makes a join on equal keys.  All pairs under that distance are found; at a
   similarity of exactly 0.8 a pair misses every key with a probability of 0.181**12 (1e-9).
3. Classes with a common key form a family (stars around each key's smallest class, never all
   pairs).  Small families meet whole in one task.
4. A family of more than BLOCK_BYTES is covered first: its members, in blocks, are held against
   HUBS of them, for ROUNDS rounds with new hubs from what is not covered yet, which is linear in the
   family.  Members that links join by then need not meet again.  The rest meets everything of a near
   set size, and what different hubs cover meets each other, block by block: for a group of near
   copies, of which hubs cover nearly all, that is a few tasks a block and not one for every two.
5. In a task, pairs that agree in enough symbols are confirmed on the full sets, and links within
   what is joined already are skipped, so that a task returns a spanning forest.

Signatures only choose what is confirmed; every link rests on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from echoloom.llm.bytehash import U64, byte_batches, shingle_sets, splitmix, to_bytes
from echoloom.llm.common import checkpointed, give_back, partitions, stored
from echoloom.llm.components import Forest, smallest_reachable

CHUNK_SYMBOLS = 4
CHUNKS = 12
ERRORS = 1
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
BITS = 16
#: Pairs at a larger signature distance are not confirmed: at a similarity of 0.8 the distance has
#: a mean of 9.6, and exceeds this with a probability under 1e-9.
MOST_DISTANCE = 30
#: Text bytes that a block of a family may hold.
BLOCK_BYTES = 1 << 20
#: Members that the others of a large family are held against, and how often such are chosen.
HUBS, ROUNDS = 12, 2
#: Members of a family that tell its usual signature.
DRAWN = 32
#: Parts that a join on families deals a hot one into.
SALTS = 32
_MULTIPLY = splitmix(np.arange(1, SYMBOLS + 1, dtype=U64)) | U64(1)
_MIX = U64(0xBF58476D1CE4E5B9)


def signature(grams: np.ndarray) -> np.ndarray:
    """SYMBOLS values of BITS bits; the permutations are odd multiplications of the mixed hashes."""
    with np.errstate(over="ignore"):
        least = np.array([(grams * m).min() for m in _MULTIPLY])
        return (splitmix(least) & U64((1 << BITS) - 1)).astype("<u2")


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature a 64-bit key for every chunk and left-out symbol."""
    words = signatures.astype(U64)
    keys = np.empty((len(words), CHUNKS * CHUNK_SYMBOLS), dtype=U64)
    with np.errstate(over="ignore"):
        for left_out in range(SYMBOLS):
            first = left_out - left_out % CHUNK_SYMBOLS
            key = np.full(len(words), left_out + 1, dtype=U64)
            for k in range(first, first + CHUNK_SYMBOLS):
                if k != left_out:
                    key = splitmix(key * _MIX + words[:, k])
            keys[:, left_out] = key
    return keys.view(np.int64)


def _describe(size: int):
    """(doc_id, text) to (doc_id, n_shingles, bytes, class, signature, digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            rows = ((i, to_bytes(t.as_py())) for i, t in zip(batch.column(0).to_pylist(), batch.column(1)))
            for part in byte_batches(rows):
                sets = shingle_sets([t for _, t in part], size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in part], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([len(t) for _, t in part], pa.int64()),
                        pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                        pa.array([hashlib.md5(t).digest() for _, t in part], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "bytes", "class", "signature", "digest"],
                )
        give_back()

    return run


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, signature) to (key, class); of classes with one key in a batch, stars and one posting."""
    for batch in batches:
        if not batch.num_rows:
            continue
        classes = np.array(batch.column(0).to_pylist(), dtype="S16")
        order = np.argsort(classes, kind="stable")
        raw = b"".join(batch.column(1).to_pylist())
        keys = chunk_keys(np.frombuffer(raw, dtype="<u2").reshape(-1, SYMBOLS)[order])
        flat, owner = keys.ravel(), np.repeat(order, keys.shape[1])
        by_key = np.argsort(flat, kind="stable")  # within a key, the smallest class comes first
        flat, owner = flat[by_key], owner[by_key]
        head = np.ones(len(flat), dtype=bool)
        head[1:] = flat[1:] != flat[:-1]
        hub = owner[np.maximum.accumulate(np.where(head, np.arange(len(flat)), 0))]
        star = np.unique(np.stack([hub[~head], owner[~head]], axis=1), axis=0)
        column = batch.column(0)
        nothing = pa.nulls(int(head.sum()), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(flat[head]), column.take(pa.array(owner[head])), nothing], names=["key", "class", "other"])
        if len(star):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(star), pa.int64()), column.take(pa.array(star[:, 0])), column.take(pa.array(star[:, 1]))], names=["key", "class", "other"]
            )
    give_back()


def confirmed(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted sets."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def link_members(members: list[tuple[bytes, int, np.ndarray, np.ndarray]], percent: int) -> list[tuple[bytes, bytes]]:
    """The spanning forest of the links among (class, side, set, signature).

    Side 0 and side 1 are the two blocks of a task, held against each other only; a block by itself
    has side 2 throughout.  With one side missing there is nothing to hold against.
    """
    members = sorted(members, key=lambda m: len(m[2]))
    sizes = np.array([len(m[2]) for m in members])
    sides = np.array([m[1] for m in members])
    signs = np.stack([m[3] for m in members])
    forest, links = Forest(), []
    few, many = (np.flatnonzero(sides == k) for k in ((2, 2) if (sides == 2).any() else (0, 1)))
    if len(few) > len(many):
        few, many = many, few
    alone = few is many or (sides == 2).any()
    others = signs[many]
    for at, i in enumerate(few.tolist()):
        # Only sets that this one can be near to; in a block by itself, only those after it.
        low = at + 1 if alone else int(np.searchsorted(sizes[many], -(-sizes[i] * percent // 100), side="left"))
        high = int(np.searchsorted(sizes[many], sizes[i] * 100 // percent, side="right"))
        near = np.flatnonzero((others[low:high] != signs[i]).sum(axis=1) <= MOST_DISTANCE) + low
        for j in many[near].tolist():
            if forest.find(i) != forest.find(j) and confirmed(members[i][2], members[j][2], percent):
                forest.union(i, j)
                links.append((members[i][0], members[j][0]))
    return links


def _confirm(size: int, percent: int):
    """Rows (task, side, class, signature, text), sorted by task, to links (a, b)."""

    def finish(task: list) -> pa.RecordBatch:
        links = []
        families: dict[bytes, list] = {}
        for family, *row in task:
            families.setdefault(family, []).append(row)
        for rows in families.values():
            sets = shingle_sets([text for _, _, _, text in rows], size)
            members = [(cls, side, grams, np.frombuffer(sign, dtype="<u2")) for (side, cls, sign, _), grams in zip(rows, sets)]
            links += link_members(members, percent)
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.binary()), pa.array([b for _, b in links], pa.binary())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            columns = [batch.column(k) for k in range(6)]
            for task, family, side, cls, sign, text in zip(*columns):
                if (key := (task.as_py(), family.as_py())) != now:
                    if held:
                        yield finish(held)
                    now, held = key, []
                held.append((key[1], side.as_py(), cls.as_py(), sign.as_py(), to_bytes(text.as_py())))
        if held:
            yield finish(held)
        give_back()

    return run


def _salted(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows join few on `keys`, of which one value may hold most rows: both sides are dealt to SALTS parts."""
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("class", F.lit(1)), F.lit(SALTS)).cast("int"))
    few = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(few, [*keys, "_salt"], how).drop("_salt")


def _blocks(size) -> F.Column:
    return F.greatest(F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")


def _held(task, side) -> list:
    return [task.alias("task"), "family", side.cast("int").alias("side"), "class", "signature", "text"]


#: Text bytes that a partition of tasks gets on average.
PARTITION_BYTES = 16 << 20


def _links(rows: DataFrame, weight: int, size: int, percent: int) -> DataFrame:
    """The links that tasks (task, family, side, class, signature, text) of `weight` text bytes confirm."""
    rows = rows.repartition(partitions(rows.sparkSession, weight, PARTITION_BYTES), "task", "family")
    return rows.sortWithinPartitions("task", "family").mapInArrow(_confirm(size, percent), "a binary, b binary")


def _choose_hubs(rest: DataFrame, turn: int) -> DataFrame:
    """(family, class) of HUBS members a family: half by a hash, half by how central they are.

    A family's most frequent value of each signature symbol is that of the text that its near copies
    come from; the members that agree with the most of these are the nearest to it.  The frequent values
    are told from DRAWN members, by hash: they only say which members are tried as hubs.
    """
    symbols = F.transform(F.sequence(F.lit(0), F.lit(SYMBOLS - 1)), lambda k: F.substring(F.hex("signature"), 4 * k + F.lit(1), F.lit(4)))
    rows = rest.select("family", "class", symbols.alias("symbols"))
    drawn = Window.partitionBy("family").orderBy(F.xxhash64("class", F.lit(-1 - turn)), "class")
    some = rows.withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= DRAWN)
    counted = some.select("family", F.posexplode("symbols").alias("place", "symbol")).groupBy("family", "place", "symbol").agg(F.count("*").alias("n"))
    usual = counted.groupBy("family", "place").agg(F.max(F.struct("n", "symbol")).alias("top"))
    usual = usual.groupBy("family").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "top"))), lambda x: x["top"]["symbol"]).alias("usual"))  # SYMBOLS entries
    same = F.aggregate(F.zip_with("symbols", "usual", lambda a, b: (a == b).cast("int")), F.lit(0), lambda x, y: x + y)
    rows = _salted(rows, usual, ["family"]).select("family", "class", same.alias("same"))
    central = Window.partitionBy("family").orderBy(F.desc("same"), "class")
    drawn = Window.partitionBy("family").orderBy(F.xxhash64("class", F.lit(turn)), "class")
    first = [rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= HUBS // 2).select("family", "class") for order in (central, drawn)]
    return first[0].union(first[1]).distinct()


def _cover(large: DataFrame, covered: DataFrame | None, turn: int, size: int, percent: int) -> DataFrame:
    """Links of what is not covered of the large families with hubs chosen from it."""
    rest = large if covered is None else large.join(covered.select(F.col("node").alias("class")), "class", "left_anti")
    hubs = stored(_choose_hubs(rest, turn).join(rest.drop("family"), "class").select("family", "class", "signature", "text"))
    blocks = rest.groupBy("family").agg(_blocks(F.sum("bytes")).alias("blocks"))
    members = _salted(rest, blocks, ["family"]).withColumn("task", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    sent = hubs.join(blocks, "family").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Hubs are members as well (side 0), so that they meet each other; a member never meets itself.
    sides = members.select(*_held(F.col("task"), F.lit(0))).unionByName(sent.select(*_held(F.col("task"), F.lit(1))))
    return _links(sides, _weight(large), size, percent)


def _weight(rows: DataFrame) -> int:
    return int(rows.agg(F.sum("bytes")).first()[0] or 0)


def _rest(large: DataFrame, covered: DataFrame, size: int, percent: int) -> DataFrame:
    """Links of the pairs that covering leaves open: rows go to a task for each unit that theirs meets.

    A unit is a block of a family's members of one size class (sets of sizes within a factor of 1.25,
    the most by which linked sets differ) and of one covered group, or of what no hub covers.
    """
    marked = large.join(covered, large["class"] == covered.node, "left").drop("node")
    marked = marked.withColumns({"loose": F.col("root").isNull(), "group": F.coalesce("root", F.lit("").cast("binary")), "size_class": F.floor(F.log("n_shingles") / F.log(F.lit(1.25))).cast("int")})
    keys = ["family", "size_class", "group", "loose"]
    counts = marked.groupBy(*keys).agg(_blocks(F.sum("bytes")).alias("blocks"))
    units = stored(counts.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks").withColumn("unit", F.xxhash64(*keys, "block")))
    other = units.select("family", *[F.col(c).alias(f"o_{c}") for c in ("size_class", "group", "loose", "unit")])
    # Each pair of units once: the size class above, or the same one and the larger number, or itself if loose.
    above = other.withColumn("size_class", F.col("o_size_class") - 1).unionByName(other.withColumn("size_class", F.col("o_size_class")))
    pairs = units.join(above, ["family", "size_class"]).where("o_size_class > size_class or o_unit > unit or (o_unit = unit and loose)")
    pairs = pairs.where(F.col("loose") | F.col("o_loose") | (F.col("group") != F.col("o_group")))
    pairs = stored(pairs.select("unit", "o_unit", F.xxhash64("unit", "o_unit").alias("task")))
    left = pairs.select("unit", "task", F.when(F.col("unit") == F.col("o_unit"), 2).otherwise(0).alias("side"))
    right = pairs.where("unit <> o_unit").select(F.col("o_unit").alias("unit"), "task", F.lit(1).alias("side"))
    placed = _salted(marked, counts, keys).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    sides = placed.withColumn("unit", F.xxhash64(*keys, "block")).join(left.unionByName(right), "unit").select(*_held(F.col("task"), F.col("side")))
    return _links(sides, 2 * BLOCK_BYTES * pairs.count(), size, percent)


#: The least similarity for which the size classes, MOST_DISTANCE and the chunks are made.
LEAST_PERCENT = 80


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of (doc_id, text).

    `component_id` is the smallest doc_id reachable over links of at least `percent` per cent
    Jaccard similarity.  Null or empty texts and texts without words have no shingles and stay by
    themselves; a text of fewer than `size` words is one shingle.  Repeated rows each get a row.  A
    null doc_id is never a component's id unless all its members' are null; such rows are not kept.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent must be at least {LEAST_PERCENT}: size classes, distance bound and chunks hold from there on")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kind = "doc_id long, n_shingles long, bytes long, class binary, signature binary, digest binary"
    known = stored(docs.mapInArrow(_describe(size), kind))
    # One text stands for a class: that of its least (doc_id, digest).
    classes = known.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("least"), F.any_value("signature").alias("signature"), F.any_value("n_shingles").alias("n_shingles"),
        F.max("bytes").alias("bytes"), F.min(F.struct("doc_id", "digest")).alias("holder"),
    )
    classes = stored(classes)

    posted = stored(classes.select("class", "signature").mapInArrow(_post, "key long, class binary, other binary"))
    postings = posted.where("key is not null").select("key", "class")
    hubs = postings.groupBy("key").agg(F.min("class").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub")
    stars = postings.join(hubs, "key").where("class <> hub").select(F.col("class").alias("a"), F.col("hub").alias("b"))
    local = posted.where("key is null").select(F.col("class").alias("a"), F.col("other").alias("b"))
    families = smallest_reachable(stars.union(local))

    members = families.join(classes, families.node == classes["class"]).select("class", F.col("root").alias("family"), "signature", "n_shingles", "bytes", "holder")
    sought = members.withColumn("at", F.struct(F.coalesce(F.col("holder.doc_id"), F.lit(0)).alias("id"), F.col("holder.doc_id").isNull().alias("none"), F.col("holder.digest").alias("digest"))).drop("holder")
    here = docs.select(F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest")).alias("at"), "text")
    rows = sought.join(here, "at").drop("at")
    if known.groupBy("doc_id", "digest").count().where("count > 1").limit(1).count():
        rows = rows.dropDuplicates(["class"])  # whole rows are repeated; otherwise texts need not be sorted by class
    rows = stored(rows)
    weight = rows.groupBy("family").agg(F.sum("bytes").alias("family_bytes")).where(F.col("family_bytes") > BLOCK_BYTES)
    marked = _salted(rows, weight, ["family"], "left")
    small = marked.where("family_bytes is null").select(*_held(F.hash("family"), F.lit(2)))
    links = checkpointed(_links(small, _weight(rows), size, percent))
    large = stored(marked.where("family_bytes is not null").drop("family_bytes"))
    if large.limit(1).count():
        found, covered = None, None
        for turn in range(ROUNDS):
            more = checkpointed(_cover(large, covered, turn, size, percent))
            found = more if found is None else found.union(more)
            covered = smallest_reachable(found)
        links = links.union(found).union(checkpointed(_rest(large, covered, size, percent)))

    roots = smallest_reachable(links)
    labels = classes.join(roots, classes["class"] == roots.node, "left").select("class", F.coalesce("root", "class").alias("root"), "least")
    least = labels.groupBy("root").agg(F.min("least").alias("component"))
    labels = labels.join(least, "root").select("class", "component")
    out = known.join(labels, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"), "class"
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near-duplicates: of every component the row with the smallest doc_id.

    Of rows that repeat that doc_id within the component one stays.  Rows with a null doc_id stay
    unless a row with an id is in their component, or a row with a null id and the same text stays.
    """
    found = near_duplicates(docs, size, percent)
    stays = "kept or (component_id is null and doc_id is null)"
    decided = found.groupBy(F.col("doc_id").alias("_near_key")).agg(F.count("*").alias("_near_rows"), F.count_if(F.expr(stays)).alias("_near_stay"))
    decided = decided.where("_near_stay > 0")
    single = decided.where("_near_rows = 1 and _near_key is not null").select("_near_key")
    named = docs.withColumn("_near_key", F.col("doc_id").cast("long"))
    once = named.join(single, "_near_key", "left_semi").drop("_near_key")
    several = decided.where("_near_rows > 1 or _near_key is null").select(F.col("_near_key").alias("_near_other"))
    repeated = named.join(several, F.col("_near_key").eqNullSafe(F.col("_near_other")), "left_semi")
    repeated = _one_per_set(repeated, found.where(stays), size)
    return once.unionByName(repeated)


def _one_per_set(rows: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """One row of each doc_id and shingle class among `rows`, which only hold repeated ids."""
    columns = [c for c in rows.columns if c != "_near_key"]
    others = [c for c in columns if c != "text"]
    packed = rows.select(F.col("_near_key").alias("_key"), F.col("text").cast("string"), F.struct(*[rows[c] for c in others]).alias("rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            classes = []
            for part in byte_batches(enumerate(map(lambda t: to_bytes(t.as_py()), batch.column(1)))):
                classes += [hashlib.md5(s.tobytes()).digest() for s in shingle_sets([t for _, t in part], size)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(classes, pa.binary())], names=["_key", "text", "rest", "_class"])

    schema = StructType([*packed.schema.fields, StructField("_class", BinaryType())])
    marked = packed.mapInArrow(run, schema)
    stay = found.select(F.col("doc_id").alias("_stay"), F.coalesce("class", F.unhex(F.md5(F.lit("").cast("binary")))).alias("_of")).distinct()
    marked = marked.join(stay, F.col("_key").eqNullSafe(F.col("_stay")) & (F.col("_class") == F.col("_of")))
    # Rows without words are linked with nothing, so that only exact repeats of a row go.
    first = marked.dropDuplicates(["_key", "_class"])
    return first.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in columns])
