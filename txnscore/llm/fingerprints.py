"""Document fingerprints: SimHash of 128 bits over shingles of five words.

Every occurrence of a shingle votes with its hash on each bit, so a shingle weighs as often as it stands in the
text. The votes of two bits are summed in one long, so that a document is one row of 64 sums, combined in each task
before the shuffle. All fingerprints within the Hamming radius are found by permuted block tables: the bits are cut
into ``radius + 2`` blocks, of which two at least stay the same, so there is one table per pair of blocks. In each
bucket the members are compared with the smallest one, and those that are farther from it with all members; a crowded
bucket is cut by tables over other blocks before that. Copies of one fingerprint are one member.

Defined results: a null text is empty; a text without words has fingerprint zero, one with fewer than five words is
one shingle. Rows with the same id each get a result; as a next document such rows count as the greatest text and
the greatest likeness among them. A row with a null id stands outside the order, its next document is empty and
``near_next`` is null. A single document is its own next document. Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscore.llm.common import addressed, whole_text
from txnscore.llm.components import components
from txnscore.workspace import written

WORDS = 5
GAP = r"[\x20\x09-\x0D]+"
BITS = 128
RADIUS = 3
#: A bucket with more members is cut anew, so often at most.
CROWD, LEVELS = 1000, 3
#: Sums per half: the votes on bit i and bit i + 32 share a long.
LANES = 32
PAIR = (1 << 32) | 1


def shingle_hashes(text: Column, width: int = WORDS) -> Column:
    """The hash of every run of ``width`` words; one of all words if there are fewer."""
    words = F.filter(F.split(text, GAP), lambda word: word != "")
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    runs = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])
    )
    none = F.array().cast("array<bigint>")
    # The hashes are bound to a name once, so that they are not computed again for each use.
    return F.element_at(
        F.transform(
            F.array(hashes),
            lambda h: F.when(F.size(h) >= width, runs(h)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(none),
        ),
        1,
    )


def _votes() -> list[Column]:
    second = F.when(F.col("_hash").isNotNull(), F.xxhash64(F.col("_hash"), F.lit(1)))
    halves = [F.col("_hash"), second]
    return [
        F.sum(F.shiftrightunsigned(half, lane).bitwiseAND(F.lit(PAIR))).alias(f"_v{k}_{lane}")
        for k, half in enumerate(halves)
        for lane in range(LANES)
    ]


def _half(k: int) -> Column:
    """The long whose bits are those with more than half of the votes."""
    bits = []
    for bit in range(64):
        votes = F.col(f"_v{k}_{bit % LANES}")
        count = F.shiftrightunsigned(votes, 32) if bit >= LANES else votes.bitwiseAND(F.lit(0xFFFFFFFF))
        bits.append(F.shiftleft((2 * count > F.col("_n")).cast("long"), bit))
    # Added up in pairs, so that the expression stays flat.
    while len(bits) > 1:
        bits = [left.bitwiseOR(right) for left, right in zip(bits[::2], bits[1::2], strict=True)]
    return F.coalesce(bits[0], F.lit(0).cast("long"))


def fingerprints(hashed: DataFrame, *keys: str) -> DataFrame:
    """Per ``keys``, the fingerprint halves ``hi`` and ``lo`` of the hashes in ``_hashes``."""
    exploded = hashed.select(*keys, F.explode_outer("_hashes").alias("_hash"))
    sums = exploded.groupBy(*keys).agg(F.count("_hash").alias("_n"), *_votes())
    return sums.select(*keys, _half(0).alias("hi"), _half(1).alias("lo"))


def distance(left: str, right: str) -> Column:
    """Hamming distance of the fingerprints of two named rows."""
    return sum(
        (F.bit_count(F.col(f"{left}.{half}").bitwiseXOR(F.col(f"{right}.{half}"))) for half in ("hi", "lo")),
        F.lit(0),
    )


def _likeness(hi: str, lo: str, other_hi: str, other_lo: str) -> Column:
    apart = F.bit_count(F.col(hi).bitwiseXOR(F.col(other_hi))) + F.bit_count(F.col(lo).bitwiseXOR(F.col(other_lo)))
    return F.lit(1.0) - apart / F.lit(float(BITS))


def as_text(hi: str, lo: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def next_ids(ids: DataFrame) -> DataFrame:
    """(``id``, ``next_id``): the next smaller id, after the smallest the largest.

    Ids are dealt out by ranges and ordered inside these; a range's smallest id follows on the largest of the range before,
    for which one window sees a row per range.
    """
    dealt = ids.distinct().repartitionByRange("id").select("id", F.spark_partition_id().alias("part"))
    dealt = written(dealt, "ranges")
    tops = dealt.groupBy("part").agg(F.max("id").alias("top"))
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = tops.select(
        "part", F.lag("top").over(Window.orderBy("part")).alias("before"), F.max("top").over(everything).alias("last")
    )
    near = dealt.withColumn("near", F.lag("id").over(Window.partitionBy("part").orderBy("id")))
    return near.join(edges, "part").select("id", F.coalesce("near", "before", "last").alias("next_id"))


def followers(texts: DataFrame) -> DataFrame:
    """Per id that is not null, its ``next_id`` and the most code points that one of its rows ``need`` of that text."""
    known = texts.where("id is not null")
    needs = written(known.groupBy("id").agg(F.max(F.floor(F.length("text") / 2)).alias("need")), "needs")
    return written(next_ids(needs.select("id")).join(needs, "id"), "next")


def with_edited_text(texts: DataFrame, follow: DataFrame) -> DataFrame:
    """Rows (``id``, ``text``, ``file``, ``row``) with ``edited``.

    ``edited`` is the text with its last half replaced by as many first code points of the next document.
    """
    # Both joins below read the same columns of the texts by the same plan, so Spark shuffles them once; that is why the
    # place of a row goes through the first one, too.
    known, outside = texts.where("id is not null"), texts.where("id is null")
    lent = known.join(follow.select(F.col("id").alias("for_id"), F.col("next_id").alias("id"), "need"), "id").select(
        F.col("for_id").alias("id"),
        F.struct(F.substring("text", F.lit(1), F.col("need").cast("int")).alias("lent"), "file", "row").alias("best"),
    )
    lent = lent.groupBy("id").agg(F.max("best").alias("best")).select("id", F.col("best.lent").alias("lent"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half),
        F.substring(F.coalesce("lent", F.lit("")), F.lit(1), half),
    )
    lent_rows = known.join(lent, "id", "left").unionByName(outside.withColumn("lent", F.lit(None).cast("string")))
    return lent_rows.select("id", "text", "file", "row", edited.alias("edited"))


def _blocks(level: int, count: int) -> list[tuple[int, int]]:
    """The bits cut into ``count`` blocks, as masks of the two halves; each level deals the bits out in another way.

    On level 0 blocks are stretches, on level 1 every ``count``-th bit, on level 2 every ``count``-th run of ``count`` bits.
    """
    masks = [[0, 0] for _ in range(count)]
    for bit in range(BITS):
        block = bit // count ** (level - 1) % count if level else bit * count // BITS
        masks[block][bit < 64] |= 1 << bit % 64
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    return [(signed(hi), signed(lo)) for hi, lo in masks]


def block_tables(members: DataFrame, level: int = 0, radius: int = RADIUS) -> DataFrame:
    """Rows (``member``, ``hi``, ``lo``) with a ``bucket`` in each of the finer buckets of theirs.

    Of ``radius + 2`` blocks, two are untouched by ``radius`` changed bits, so near members share a bucket.
    """
    count = radius + 2
    values = [
        [F.col(half).bitwiseAND(F.lit(mask)) for half, mask in zip(("hi", "lo"), masks, strict=True)]
        for masks in _blocks(level, count)
    ]
    tables = [
        F.xxhash64("bucket", F.lit(number), *values[left], *values[right])
        for number, (left, right) in enumerate(combinations(range(count), 2))
    ]
    return members.select("member", "hi", "lo", F.explode(F.array(*tables)).alias("bucket"))


def _links_in_buckets(tables: DataFrame, radius: int) -> DataFrame:
    """Links of members of a bucket: to its smallest where that is near, and of the others to all."""
    firsts = tables.where("member = first").select("bucket", "hi", "lo").distinct()
    apart = distance("m", "f")
    measured = tables.alias("m").join(firsts.alias("f"), F.col("m.bucket") == F.col("f.bucket")).select(
        "m.bucket", "m.member", "m.hi", "m.lo", "m.first", (apart <= radius).alias("near")
    )
    measured = written(measured, "measured")
    to_first = measured.where("near and member <> first").select(F.col("member").alias("a"), F.col("first").alias("b"))
    far = measured.where("not near")
    pairs = far.alias("m").join(
        measured.where("member <> first").alias("f"),
        (F.col("m.bucket") == F.col("f.bucket")) & (F.col("m.member") != F.col("f.member")),
    )
    to_others = pairs.where(apart <= radius).select(F.col("m.member").alias("a"), F.col("f.member").alias("b"))
    return to_first.unionByName(to_others)


def near_links(members: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Links (``a``, ``b``) that tie together all members within the radius of each other.

    A bucket of more than ``crowd`` members is cut by tables of its own over other blocks, up to ``LEVELS`` times, in
    which near members share a bucket again; nothing is left out.
    """
    rows, links = members.withColumn("bucket", F.lit(0).cast("long")), []
    for level in range(LEVELS):
        tables = block_tables(rows, level, radius)
        shared = tables.groupBy("bucket").agg(F.min("member").alias("first"), F.count("*").alias("n")).where("n > 1")
        tables = written(tables.join(shared, "bucket"), "buckets")
        last = level == LEVELS - 1
        links.append(_links_in_buckets(tables if last else tables.where(F.col("n") <= crowd), radius))
        rows = tables.where(F.col("n") > crowd).select("member", "hi", "lo", "bucket")
        if last or rows.isEmpty():
            break
    return reduce(DataFrame.unionByName, links).distinct()


def near_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(``hi``, ``lo``, ``class_id``): the smallest id reachable over fingerprints within the radius."""
    members = written(prints.groupBy("hi", "lo").agg(F.min("id").alias("member")), "members")
    known = members.where("member is not null")
    tied = components(near_links(known, radius))
    return members.join(tied, F.col("member") == F.col("id"), "left").select(
        "hi", "lo", F.coalesce("component", "member").alias("class_id")
    )


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, see the module's first lines."""
    # A row is told by its place in the files, which stays the same when a lost task runs again.
    placed = addressed(docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")))
    texts = placed.select("id", "text", F.xxhash64("_file").alias("file"), F.col("_row").alias("row"))
    follow = followers(texts)
    both = with_edited_text(texts, follow).select(
        "id",
        "file",
        "row",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.array(F.col("text"), F.col("edited")).alias("sides"),
    )
    sides = both.select("id", "file", "row", "n_chars", "edited_sha256", F.posexplode("sides").alias("side", "body"))
    sides = sides.withColumn("_hashes", shingle_hashes(F.col("body")))
    prints = written(fingerprints(sides, "id", "file", "row", "n_chars", "edited_sha256", "side"), "prints")
    own, edited = prints.where("side = 0").drop("side"), prints.where("side = 1")
    rows = own.join(
        edited.select("file", "row", F.col("hi").alias("edited_hi"), F.col("lo").alias("edited_lo")), ["file", "row"]
    )
    after = own.select(F.col("id").alias("next_id"), F.col("hi").alias("next_hi"), F.col("lo").alias("next_lo"))
    likeness = rows.join(follow, "id").join(after, "next_id").groupBy("file", "row").agg(
        F.max(_likeness("hi", "lo", "next_hi", "next_lo")).alias("near_next")
    )
    classes = near_classes(own)
    return (
        rows.join(likeness, ["file", "row"], "left")
        .join(classes, ["hi", "lo"])
        .select(
            F.col("id").alias("doc_id"),
            "n_chars",
            "edited_sha256",
            as_text("hi", "lo").alias("fingerprint"),
            as_text("edited_hi", "edited_lo").alias("edited_fingerprint"),
            _likeness("hi", "lo", "edited_hi", "edited_lo").alias("near_edited"),
            "near_next",
            "class_id",
        )
    )


def op7_fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return document_fingerprints(docs)
