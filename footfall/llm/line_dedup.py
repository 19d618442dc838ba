"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

A line is cut into one segment more than the edits allowed, so that one segment of the shorter of two near lines stands
unchanged in the longer one, not far from its place. Segments are indexed by the line's length, their number and their text; every line
probes the lengths it can match with the few substrings that can be such a segment. Lines that meet no other line there are done.
The others get a signature, the parity of their characters and of their pairs of neighbouring characters on a few bits: an edit
turns few of these bits, so that the join of segments leaves out pairs with too many different ones. That matters where many
versions of one line share segments. Pairs that are left are verified by a banded bit-parallel edit distance.

A line may differ by one edit for every CHARS_PER_EDIT characters of the shorter line, and by no more than `edits`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored
from footfall.llm.components import components

EDITS = 2
CHARS_PER_EDIT = 16
#: Before an exact look, a line is cut into so many parts; each edit can spoil one of them.
PARTS = 12
#: Words of 64 bits in the signature of neighbouring characters; a power of two.
SIGNATURE_WORDS = 4
#: Up to so many keys or candidate lines (8 bytes each) are broadcast to all of them; beyond, both are shuffled.
BROADCAST_CANDIDATES = 500_000
#: The same for lines with links, by their identifiers and places (about 150 bytes each).
BROADCAST_LINES = 100_000


def allowed(length: Column, edits: int) -> Column:
    """Edits that a line of this length allows."""
    return F.least(F.lit(edits), F.floor(length / CHARS_PER_EDIT).cast("int"))


def segment(length: Column, count: Column, number: Column) -> tuple[Column, Column]:
    """Start (from 1) and length of a segment; the first ones are shorter by one where lengths do not divide."""
    base = F.floor(length / count).cast("int")
    short = count - length % count
    start = 1 + (number - 1) * base + F.greatest(F.lit(0), number - 1 - short)
    return start, base + F.when(number > short, 1).otherwise(0)


def lookups(edits: int) -> list[tuple[int, int, int, int]]:
    """(allowed, longer, number, shift): the substrings a line probes with, for each number of edits allowed to the indexed line.

    `longer` is by how much the probing line is longer. A segment with number i has i - 1 segments before it: were more than i - 1
    edits there, a segment further left or right would match as well. That bounds the shift from both sides. With neither
    difference nor shift the substring is the line's own segment, which stands in the index.
    """
    rows = []
    for allow in range(1, edits + 1):
        for longer in range(allow + 1):
            for i in range(1, allow + 2):
                behind = allow + 1 - i
                shifts = range(max(1 - i, longer - behind), min(i - 1, longer + behind) + 1)
                rows += [(allow, longer, i, shift) for shift in shifts]
    return rows


def keyed(lines: DataFrame, edits: int) -> DataFrame:
    """(key, h, own) of every line (h, line, size) long enough for an edit; own keys stand in the index."""
    table = ", ".join(f"struct({a} AS allow, {d} AS longer, {i} AS number, {s} AS shift)" for a, d, i, s in lookups(edits))
    each = lines.select("h", "line", "size", F.inline(F.expr(f"array({table})")))
    indexed = F.col("size") - F.col("longer")
    each = each.filter(F.col("allow") == allowed(indexed, edits))
    start, length = segment(indexed, F.col("allow") + 1, F.col("number"))
    text = F.substring(F.col("line"), start + F.col("shift"), length)
    own = (F.col("longer") == 0) & (F.col("shift") == 0)
    return each.select(F.xxhash64(indexed, F.col("number"), text).alias("key"), "h", own.alias("own"))


def met(lines: DataFrame, edits: int) -> DataFrame:
    """The keys (key, h, own) under which a line in the index meets another line.

    One aggregation, merged on the map side, says which keys do: a key that many lines share leaves each task once. The keys are
    then made anew and held against those, which are broadcast only if they were counted to be few.
    """
    keys = keyed(lines, edits)
    shared = keys.groupBy("key").agg(F.min("h").alias("first"), F.max("h").alias("last"), F.max("own").alias("indexed"))
    return few(keys, shared.filter("indexed AND first <> last").select("key"), "key")


def signature(line: Column) -> Column:
    """Parities of a line: of its characters on 64 bits (s0), of its neighbouring characters on SIGNATURE_WORDS times 64 (s1, ...).

    An edit takes one character and puts one in its place at most, and so for two pairs of neighbours: it turns up to two bits of
    s0 and up to four of the others.
    """

    def parity(hashes: Column, word: int) -> Column:
        def turn(state: Column, value: Column) -> Column:
            turned = state.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63))))
            here = F.shiftright(value, 6).bitwiseAND(F.lit(SIGNATURE_WORDS - 1)) == word
            return F.when(here, turned).otherwise(state)

        return F.aggregate(hashes, F.lit(0).cast("long"), turn)

    chars = F.split(line, "")
    double = F.zip_with(chars, F.slice(chars, 2, F.greatest(F.size(chars), F.lit(1))), lambda c, d: F.hash(c, d))
    single = F.transform(chars, lambda c: F.hash(c).bitwiseAND(F.lit(63)))
    words = [parity(double, word).alias(f"s{word + 1}") for word in range(SIGNATURE_WORDS)]
    return F.struct(parity(single, 0).alias("s0"), *words)


def likely(left: Column, right: Column, size: Column, edits: int) -> Column:
    """Whether two signatures differ in no more bits than the edits allowed can turn."""
    allow = allowed(size, edits)
    turned = [F.bit_count(left[f"s{i}"].bitwiseXOR(right[f"s{i}"])) for i in range(SIGNATURE_WORDS + 1)]
    return (turned[0] <= 2 * allow) & (sum(turned[2:], turned[1]) <= 4 * allow)


def candidates(lines: DataFrame, edits: int) -> DataFrame:
    """Pairs (a, b) of different lines, by hash, that share a segment where two near lines may and have like signatures."""
    keys = stored(met(lines, edits))
    signed = stored(few(lines, keys.select("h").distinct(), "h").select("h", "size", signature(F.col("line")).alias("s")))
    known = keys.join(signed, "h")
    index = known.filter("own").select("key", F.col("h").alias("x"), F.col("size").alias("nx"), F.col("s").alias("sx"))
    probes = known.select("key", F.col("h").alias("y"), F.col("size").alias("ny"), F.col("s").alias("sy"))
    # A line probes for shorter ones or equally long ones.
    close = likely(F.col("sx"), F.col("sy"), F.col("nx"), edits)
    pairs = index.withColumnRenamed("key", "index_key").join(
        probes, (F.col("index_key") == F.col("key")) & (F.col("x") != F.col("y")) & (F.col("nx") <= F.col("ny")) & close
    )
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def counted(rows: DataFrame, most: int = BROADCAST_LINES) -> DataFrame:
    """`rows`, written, for a join: to be broadcast if they were counted to be few, so that the other side need not be shuffled."""
    rows = stored(rows)
    return F.broadcast(rows) if rows.count() <= most else rows


def few(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows whose hash in `column` is in `wanted`."""
    return rows.join(counted(wanted, BROADCAST_CANDIDATES), column, "left_semi")


def parts_agree(short: Column, long: Column, edits: int) -> Column:
    """Whether all but `edits` parts of the shorter line stand in the longer one near their place: no near line fails."""
    size = F.length(short)
    found = []
    for number in range(1, PARTS + 1):
        start, length = segment(size, F.lit(PARTS), F.lit(number))
        begin = F.greatest(F.lit(1), start - edits)
        around = F.substring(long, begin, start + edits + length - begin)
        found.append(F.contains(around, F.substring(short, start, length)).cast("int"))
    return sum(found[1:], found[0]) >= PARTS - edits


def edit_distance(short: Column, long: Column, edits: int) -> Column:
    """The edit distance if it is at most `edits`, else edits + 1; lengths may differ by no more than `edits`.

    Bit-parallel in a band: bit b of vector e says that, after j characters of the longer line, j + b - edits characters of the
    shorter one can be matched with e edits. One step shifts and joins the vectors for all the band at once.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1

    def named(value: Column, use: Callable[[Column], Column]) -> Column:
        # A lambda's argument is computed once, however often it is used.
        return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))

    def step(state: Column, hits: Column) -> Column:
        new = [state["r0"].bitwiseAND(hits)]
        for e in range(1, edits + 1):
            old, less = state[f"r{e}"], state[f"r{e - 1}"]
            moved = F.shiftright(less, 1).bitwiseOR(F.shiftleft(new[-1], 1).bitwiseAND(F.lit(full)))
            new.append(old.bitwiseAND(hits).bitwiseOR(less).bitwiseOR(moved))
        return F.struct(*(r.alias(f"r{e}") for e, r in enumerate(new)))

    def masks(pattern: Column) -> Column:
        # Beyond the ends of the pattern stand empty texts, which equal no character.
        def mask(char: Column, at: Column) -> Column:
            same = [F.when(F.get(pattern, at + b) == char, 1 << b).otherwise(0) for b in range(width)]
            return sum(same[1:], same[0])

        return F.transform(F.split(long, ""), mask)

    def distance(ended: Column) -> Column:
        end = F.call_function("shiftleft", F.lit(1), F.length(short) - F.length(long) + edits)
        least = F.lit(edits + 1)
        for e in range(edits, -1, -1):
            least = F.when(ended[f"r{e}"].bitwiseAND(end) != 0, e).otherwise(least)
        return least

    first = [sum(1 << b for b in range(edits, edits + e + 1)) & full for e in range(edits + 1)]
    start = F.struct(*(F.lit(r).alias(f"r{e}") for e, r in enumerate(first)))
    pattern = F.concat(F.array_repeat(F.lit(""), edits), F.split(short, ""), F.array_repeat(F.lit(""), width))
    return named(F.aggregate(named(pattern, masks), start, step), distance)


def near_lines(
    rows: DataFrame, edits: int = EDITS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for every distinct line: line_id, doc_id and line_no of its first place, copies, links, keep_doc_id, keep_line_no.

    Lines are what line ends (\\n) leave; null texts are empty, an empty text is one empty line. `copies` counts the places of the
    line, `links` the other lines near it. Of a group that links tie together the line that comes first (by doc_id, null last,
    then line_no) is kept; other rows name it. `line_id` is the SHA-256 of the line in hex. Ties, as with repeated ids, go to the
    smaller line_id. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    each = rows.select(F.col(id_column).cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("line_no"))
    lines = stored(
        each.groupBy("line")
        .agg(F.min(place).alias("place"), F.count("*").alias("copies"))
        .select("line", "place", "copies", F.xxhash64("line").alias("h"), F.length("line").alias("size")),
        compression="zstd",
    )
    pairs = stored(candidates(lines.select("h", "line", "size"), edits))
    line_id = F.sha2("line", 256)
    texts = stored(few(lines, pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "h").select("h", "line", "size"))
    left = texts.select(F.col("h").alias("a"), F.col("line").alias("la"), F.col("size").alias("sa"))
    right = texts.select(F.col("h").alias("b"), F.col("line").alias("lb"), F.col("size").alias("sb"))
    ordered = pairs.join(left, "a").join(right, "b").select(
        F.when(F.col("sa") <= F.col("sb"), F.col("la")).otherwise(F.col("lb")).alias("short"),
        F.when(F.col("sa") <= F.col("sb"), F.col("lb")).otherwise(F.col("la")).alias("long"),
    )
    ordered = ordered.filter(F.length("long") - F.length("short") <= allowed(F.length("short"), edits))
    agreeing = ordered.filter(parts_agree(F.col("short"), F.col("long"), edits))
    near = agreeing.filter(edit_distance(F.col("short"), F.col("long"), edits) <= allowed(F.length("short"), edits))
    links = stored(near.select(F.sha2("short", 256).alias("a"), F.sha2("long", 256).alias("b")))
    degrees = links.select(F.explode(F.array("a", "b")).alias("line_id")).groupBy("line_id").agg(F.count("*").alias("links"))
    groups = components(links).withColumnRenamed("node", "line_id")
    known = lines.select(line_id.alias("line_id"), "place", "copies")
    tied = stored(known.join(counted(groups.join(degrees, "line_id")), "line_id"))
    first = tied.groupBy("component").agg(F.min(F.struct("place", "line_id")).alias("keep"))
    tied = tied.join(first, "component").select("line_id", "links", F.col("keep.place").alias("keep"))
    return known.join(counted(tied), "line_id", "left").select(
        "line_id",
        F.col("place.doc_id").alias("doc_id"),
        F.col("place.line_no").alias("line_no"),
        "copies",
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        F.coalesce("keep.doc_id", "place.doc_id").alias("keep_doc_id"),
        F.coalesce("keep.line_no", "place.line_no").alias("keep_line_no"),
    )
