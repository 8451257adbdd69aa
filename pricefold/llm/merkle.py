"""Operator 11: fingerprints of documents as Merkle trees over sections and paragraphs, in DataFrame operations only.

A text falls into sections (ended by a blank line, or by a heading below), sections into paragraphs (lines), and
paragraphs into phrases, which are the leaves. A phrase ends after a white space behind punctuation or one of two common
letters, so where it ends depends on the signs beside it alone and an edit leaves the other phrases as they are. A
leaf's digest is the SHA-256 of its text, and that of a branch is the SHA-256 of its children's digests; so roots are
equal for equal texts only, and where two trees differ, the branches whose digests differ lead down to the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricefold.llm.common import located

# The signs that stand between parts while a text is cut, and those that escape them in the text itself.
ESCAPE, SECTION, PARAGRAPH, PHRASE = "\x1c", "\x1d", "\x1e", "\x1f"
ESCAPED = {"\x1c": "\x1ca", "\x1d": "\x1cb", "\x1e": "\x1cc", "\x1f": "\x1cd"}
# What is found, in turn, and what takes its place. White space is listed, as engines differ on it.
CUTS = [
    (r"(\n[\t\n\f\r ]*\n)", "$1" + SECTION),
    (r"(\n)(#{1,6} )", "$1" + SECTION + "$2"),
    (r"(\n)([^\n\x1D])", "$1" + PARAGRAPH + "$2"),
    (r"([.!?;:,st][\t\n\f\r ])([^\t\n\f\r \x1D\x1E])", "$1" + PHRASE + "$2"),
]

# Neighbours are found in groups of about so many rows; beyond so many groups, these grow instead.
_ROWS_A_GROUP = 512
_GROUPS = 32_768
_LAST = (1 << 63) - 1


def _cut(text: Column) -> Column:
    """The text with a sign between its parts; signs of this kind in the text are escaped first."""
    escaped = text
    for sign, code in ESCAPED.items():
        escaped = F.replace(escaped, F.lit(sign), F.lit(code))
    cut = F.when(text.rlike("[\x1c-\x1f]"), escaped).otherwise(text)
    for pattern, replacement in CUTS:
        cut = F.regexp_replace(cut, pattern, replacement)
    return cut


def _digest(children: Column) -> Column:
    return F.sha2(F.concat_ws("", children), 256)


def _each(parts: Column, of, depth: int = 1) -> Column:
    """``of`` each element of an array, or of the arrays in it."""
    return F.transform(parts, lambda part: of(part) if depth == 1 else _each(part, of, depth - 1))


def with_tree(frame: DataFrame, text: str, into: str) -> DataFrame:
    """Add the tree of a column of texts, none of them null.

    ``into`` is a struct: root; sections, their digests; paragraphs, theirs by section; leaves, the digests of phrases by
    section and paragraph; lengths, the code points of paragraphs by section. An empty text has one leaf, which is empty.
    """
    own = [f"{into}_{name}" for name in ("cut", "parts", "leaves", "paragraphs", "sections")]
    cut, parts, leaves, paragraphs, sections = own
    # Each step is a column of its own, so that what two others need is computed once.
    frame = frame.withColumn(cut, _cut(F.col(text)))
    frame = frame.withColumn(parts, _each(F.split(cut, SECTION, -1), lambda part: F.split(part, PARAGRAPH, -1)))
    frame = frame.withColumn(
        leaves, _each(F.col(parts), lambda part: _each(F.split(part, PHRASE, -1), lambda x: F.sha2(x, 256)), 2)
    )
    frame = frame.withColumn(paragraphs, _each(F.col(leaves), _digest, 2))
    frame = frame.withColumn(sections, _each(F.col(paragraphs), _digest))
    # An escaped sign is the escape and one more, so without escapes and cuts the length is that of the text.
    lengths = _each(F.col(parts), lambda part: F.char_length(F.translate(part, ESCAPE + PHRASE, "")).cast("bigint"), 2)
    tree = F.struct(
        _digest(F.col(sections)).alias("root"), F.col(sections).alias("sections"),
        F.col(paragraphs).alias("paragraphs"), F.col(leaves).alias("leaves"), lengths.alias("lengths"),
    )
    return frame.withColumn(into, tree).drop(*own)


def fingerprint(tree: str) -> Column:
    """A tree as a string: root, then shortened digests of sections, paragraphs and phrases, divided like their parents."""
    paragraphs = _each(F.col(f"{tree}.paragraphs"), lambda part: F.array_join(_each(part, lambda x: F.left(x, F.lit(16))), ","))
    phrases = _each(F.col(f"{tree}.leaves"), lambda part: F.array_join(
        _each(part, lambda leaves: F.array_join(_each(leaves, lambda x: F.left(x, F.lit(8))), "")), ","
    ))
    return F.concat_ws(
        "/",
        f"{tree}.root",
        F.array_join(_each(F.col(f"{tree}.sections"), lambda x: F.left(x, F.lit(16))), ";"),
        F.array_join(paragraphs, ";"),
        F.array_join(phrases, ";"),
    )


def distinct_leaves(tree: str) -> Column:
    return F.array_distinct(F.flatten(F.flatten(F.col(f"{tree}.leaves"))))


def likeness(leaves: str, others: str) -> Column:
    """The distinct leaves that two trees share, as a part of those of the tree that has more: 0 to 1, equal texts 1."""
    return F.size(F.array_intersect(leaves, others)) / F.greatest(F.size(leaves), F.size(others))


def _first_difference(one: Column, other: Column) -> Column:
    """The index, from 0, of the first place where two arrays differ; null if they are equal."""
    place = F.array_position(F.zip_with(one, other, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(place > 0, (place - 1).cast("int"))


def with_first_edit(frame: DataFrame, before: str, after: str) -> DataFrame:
    """Walk down two trees to the first branches whose digests differ.

    Adds edit_section and edit_paragraph, their numbers from 0, and edit_start, the code points before that paragraph; all
    null where the roots are equal. A part that only one of the trees has differs.
    """
    frame = frame.withColumn("edit_section", _first_difference(F.col(f"{before}.sections"), F.col(f"{after}.sections")))

    def part(tree: str, of: str) -> Column:
        there = F.get(F.col(f"{tree}.{of}"), F.col("edit_section"))
        return F.coalesce(there, F.slice(F.col(f"{tree}.{of}")[0], 1, 0))

    frame = frame.withColumn(
        "edit_paragraph",
        F.when(
            F.col("edit_section").isNotNull(),
            _first_difference(part(before, "paragraphs"), part(after, "paragraphs")),
        ),
    )
    ahead = F.concat(
        F.flatten(F.slice(F.col(f"{after}.lengths"), 1, F.col("edit_section"))),
        F.slice(part(after, "lengths"), 1, F.col("edit_paragraph")),
    )
    start = F.aggregate(ahead, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return frame.withColumn("edit_start", F.when(F.col("edit_section").isNotNull(), start))


def fingerprinted(docs: DataFrame, text_column: str = "text", into: str = "merkle") -> DataFrame:
    """``docs`` with one more column, their tree; a null text counts as empty. All other columns and rows stay.

    ``into`` must not be a column of ``docs`` already.
    """
    if into in docs.columns:
        raise ValueError(f"there is a column {into} already")
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]) if docs.columns else F.struct()
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return with_tree(docs.select(whole.alias("doc"), text.alias("text")), "text", "tree").select(
        "doc.*", F.col("tree").alias(into)
    )


def changed_paragraphs(pairs: DataFrame, before: str, after: str) -> DataFrame:
    """A row for each paragraph of the tree ``after`` whose digest the tree ``before`` has nowhere.

    ``pairs`` has a column ``pair`` and two columns of trees; the result has pair, section, paragraph (from 0), start and
    length in code points. Branches with an equal in the other tree are left out without a look at what is in them; an
    edit that only takes paragraphs away leaves no row here, but one with the trees changed about.
    """
    pairs = pairs.where(F.col(f"{before}.root") != F.col(f"{after}.root"))
    # Both have the same order: parts of equal position belong together.
    sections = F.arrays_zip(
        F.col(f"{after}.sections").alias("digest"), F.col(f"{after}.paragraphs").alias("paragraphs"),
        F.col(f"{after}.lengths").alias("lengths"),
    )
    total = _each(F.col(f"{after}.lengths"), lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda x, y: x + y))
    rows = pairs.select(
        "pair", F.col(f"{before}.sections").alias("known_sections"),
        F.flatten(F.col(f"{before}.paragraphs")).alias("known"), total.alias("totals"),
        F.posexplode(sections).alias("section", "part"),
    ).where(~F.array_contains("known_sections", F.col("part.digest")))
    base = F.aggregate(F.slice("totals", 1, F.col("section")), F.lit(0).cast("bigint"), lambda x, y: x + y)
    rows = rows.select(
        "pair", "section", "known", base.alias("base"), F.col("part.lengths").alias("lengths"),
        F.posexplode("part.paragraphs").alias("paragraph", "digest"),
    ).where(~F.array_contains("known", F.col("digest")))
    ahead = F.aggregate(F.slice("lengths", 1, F.col("paragraph")), F.lit(0).cast("bigint"), lambda x, y: x + y)
    return rows.select(
        "pair", "section", "paragraph", (F.col("base") + ahead).alias("start"),
        F.get("lengths", F.col("paragraph")).alias("length"),
    )


def _groups(keys: DataFrame) -> tuple[DataFrame, int, int, int, bool]:
    """Intervals of about ``_ROWS_A_GROUP`` rows over the places of ``key``: group, low, high, slices.

    Also the number of bits of a place, how many bits of a key it leaves out, the first place, and whether any key has the
    rows of several groups; the interval of such a key has several slices.
    """
    ends = keys.agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).first()
    low, high = ends.low or 0, ends.high or 0
    shift = max(0, (high - low).bit_length() - 62)
    first, bits = low >> shift, max(1, ((high >> shift) - (low >> shift)).bit_length())
    groups = max(1, min(_GROUPS, ends.n // _ROWS_A_GROUP))
    cuts = []
    if groups > 1:
        place = F.shiftright("key", shift) - F.lit(first)
        fractions = [k / groups for k in range(1, groups)]
        cuts = keys.agg(F.percentile_approx(place, fractions, max(10_000, 10 * groups)).alias("cuts")).first().cuts
    bounds: list[tuple[int, int, int]] = []
    slices = {cut: cuts.count(cut) for cut in dict.fromkeys(cuts)} if len(set(cuts)) < len(cuts) else {}
    edges = sorted({0, *cuts} | {cut + 1 for cut, n in slices.items() if n > 1 and shift == 0} | {1 << bits})
    for begin, end in zip(edges, edges[1:], strict=False):
        bounds.append((begin, end, slices.get(begin, 1) if shift == 0 else 1))
    text = ";".join(f"{k},{a},{b},{n}" for k, (a, b, n) in enumerate(bounds))
    # As one literal, whatever the number of groups.
    parts = keys.sparkSession.range(1).select(F.explode(F.split(F.lit(text), ";")).alias("bound"))
    parts = parts.select(F.split("bound", ",").cast("array<bigint>").alias("bound"))
    intervals = parts.select(*[F.col("bound")[k].alias(name) for k, name in enumerate(("group", "low", "high", "slices"))])
    return intervals, bits, shift, first, any(n > 1 for *_, n in bounds)


def _with_next(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text, tree, next_text and next_tree of each row, where the next row is that with the next smaller id.

    The last row's next is the first. Null ids count as the smallest; rows with equal ids follow by a hash of the text. The
    ids are cut into groups of bounded size by their quantiles, texts are shuffled to their groups once, and the first rows
    of a group go to the one before as well. Where a key has the rows of several groups, its equal rows are counted first
    and its texts go to slices of the group by their hash.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    )
    key = F.coalesce(F.bitwise_not("doc_id"), F.lit(_LAST)).alias("key")
    intervals, bits, shift, first, heavy = _groups(rows.select(key))
    rows = rows.groupBy("doc_id", "text").agg(F.count("*").alias("copies")) if heavy else rows.withColumn("copies", F.lit(1))
    placed = rows.select("*", key).withColumn("place", F.shiftright("key", shift) - F.lit(first))
    if heavy:
        # The hash in slices of equal width, in its order.
        high = F.shiftright(F.xxhash64("text"), 24) + F.lit(1 << 39)
        slice_ = F.shiftright(high * F.col("slices"), 40)
    else:
        slice_ = F.lit(0).cast("bigint")
    # The number of groups is bounded by a parameter.
    keyed = located(placed, intervals, "place", bits, small=True).withColumn("slice", slice_)
    heads = located(placed.drop("text") if not heavy else placed, intervals, "place", bits, small=True)
    heads = heads.withColumn("slice", slice_).groupBy("group", "slice").agg(F.min("key").alias("head"))
    in_order = Window.orderBy("group", "slice")
    before = F.struct("group", "slice")
    heads = heads.select(
        "group", "slice", "head",
        F.coalesce(F.lag(before).over(in_order), F.last(before).over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        )).alias("before"),
    )
    keyed = keyed.join(F.broadcast(heads), ["group", "slice"])
    own = F.struct("group", "slice", F.lit(False).alias("ahead"))
    also = F.struct(F.col("before.group").alias("group"), F.col("before.slice").alias("slice"), F.lit(True).alias("ahead"))
    sent = F.explode(F.when(F.col("key") == F.col("head"), F.array(own, also)).otherwise(F.array(own)))
    rows = keyed.select("doc_id", "text", "copies", "key", sent.alias("to")).select("doc_id", "text", "copies", "key", "to.*")
    rows = with_tree(rows.repartition("group", "slice"), "text", "tree")
    following = Window.partitionBy("group", "slice").orderBy("ahead", "key", F.xxhash64("text"))
    rows = rows.withColumns({"next_text": F.lead("text").over(following), "next_tree": F.lead("tree").over(following)})
    rows = rows.where("not ahead").select("doc_id", "text", "tree", "next_text", "next_tree", "copies")
    if not heavy:
        return rows.drop("copies")
    # Of equal rows, each but the last is followed by another one of them.
    kinds = F.array(
        F.struct(F.lit(1).cast("bigint").alias("times"), "next_text", "next_tree"),
        F.struct((F.col("copies") - 1).alias("times"), F.col("text").alias("next_text"), F.col("tree").alias("next_tree")),
    )
    rows = rows.select("doc_id", "text", "tree", F.explode(kinds).alias("kind")).where("kind.times > 0")
    return rows.select("doc_id", "text", "tree", F.explode(F.array_repeat("kind", F.col("kind.times").cast("int"))).alias("kind")).select(
        "doc_id", "text", "tree", "kind.next_text", "kind.next_tree"
    )


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its fingerprint and that of its text with the second half replaced.

    doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (likeness to
    the edited text and to the next document), edit_section, edit_paragraph and edit_start (see ``with_first_edit``). The
    last half of the code points, rounded down, gives way to the first as many of the next document, or to all it has.
    A null text is empty, whose likeness to another empty text is 1 and to others 0. Repeated rows stay; order as in
    ``_with_next``. No documents give no rows.
    """
    rows = _with_next(docs, id_column, text_column).withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)
    )
    rows = with_tree(rows.withColumn("edited", edited), "edited", "edited_tree")
    rows = with_first_edit(rows, "tree", "edited_tree")
    rows = rows.withColumns({
        "leaves": distinct_leaves("tree"), "edited_leaves": distinct_leaves("edited_tree"),
        "next_leaves": distinct_leaves("next_tree"),
    })
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint("tree").alias("fingerprint"),
        fingerprint("edited_tree").alias("edited_fingerprint"), likeness("leaves", "edited_leaves").alias("near_edited"),
        likeness("leaves", "next_leaves").alias("near_next"), "edit_section", "edit_paragraph", "edit_start",
    )
