"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A paragraph is a stretch of text that ends with a line or a full stop before a space; its digest is the XXH64 of its
characters. A sketch has three rows of cells. A digest enters one cell of each row: the cell keeps how many entered, the
XOR of their digests and the XOR of their check values. Every version gets sketches of its own, and those of two versions
subtract cell by cell: what both hold cancels. Where a cell of the difference holds one digest (count 1 or -1, check
value right), the digest is taken out of its three cells, which lays open others (peeling). If all cells end empty, all
differing digests have been recovered; if not, larger sketches follow, until they have.

1. The fingerprint is the sketch of ``BASE`` cells a row. Fingerprints are subtracted and peeled first; near copies end here.
2. Else the counts of that difference tell about how many digests differ: a differing digest adds one to the expected
   sum of squares of each row. Sketches of that size follow. A large sketch is a set of tables of ``CELLS`` cells a row, to which
   digests are dealt by hash, about ``SHARE`` differing ones each; a table that isn't recovered is made again as two.
3. Pairs beyond ``TABLES`` tables and those that failed twice are dealt by hash into groups, each a row of its own, and
   tried with twice the tables and other hashes, round by round, until every group is recovered.

``differences`` returns the recovered digests of each pair. Likeness is the share of common digests among all (1 for two
texts without any).

Only SQL expressions and DataFrame operations are used; the nested expressions are written as SQL text, which is parsed at once. A document's next one (ascending id) comes from a window within ranges of
(id, hash of the text); the first row of each range is also put at the end of the range before.

Null texts count as empty; empty texts have no paragraph and an all-zero fingerprint. Rows are ordered by id, then a
hash of the text, so rows of equal id follow on each other; null ids come first. One row alone is its own next one, an
empty table gives an empty result. Ids and texts that many rows share are cut into ranges by the hash; only rows equal in
both lie in one range. Texts may be of any length: they are split whole, and the cells follow the number of
differing paragraphs. Columns of the input that aren't named in ``keep`` are left aside, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import input_bytes
from millrace.session import stage

BASE = 4
CELLS = 8  # cells in a row of a table
SHARE = 8  # digests that differ, a table
TABLES = 32  # tables of a pair that stays in its row
GROUP = 4  # tables of a group in a row of its own
FAN = 32  # groups made of one in a step
ROUNDS = 8
RANGE_BYTES = 8 << 20
MAX_RANGES = 10_000
HOT_ROWS = 1000
PARAGRAPH_END = r"\n|(?<=\.) "
CHECK = -1  # seed of the check value
NONE = "named_struct('n', 0, 'k', 0L, 'c', 0L)"  # an empty cell
NULL = -(1 << 63)


def let(value: str, name: str, use: str) -> str:
    """``use`` of a value that is computed once, however often its name occurs in it."""
    return f"transform(array({value}), {name} -> {use})[0]"


def digests(text: Column) -> Column:
    """The different digests of a text's paragraphs."""
    parts = F.filter(F.split(text, PARAGRAPH_END, -1), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _places(width: int) -> str:
    """One bit for each cell of the three rows."""
    return f"array({', '.join(f'{1 << i}L' for i in range(3 * width))})"


def _mask(h: str, width: int) -> str:
    """The bits of the three cells that a hash names; ``width`` is a power of two."""
    bits = width.bit_length() - 1
    return " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned({h}, {r * bits}) & {width - 1}L AS INT) + {r * width})" for r in range(3))


def entries(keys: str, width: int, seed: int, tables: str = "1L") -> str:
    """What enters the cells: n = 1, digest k, check value c, mask m of its cells, and its table t."""
    hashed = f"transform({keys}, k -> named_struct('k', k, 'h', xxhash64(k, {seed})))"
    table = f"shiftrightunsigned(e.h, 16) % {tables}"
    return f"transform({hashed}, e -> named_struct('n', 1, 'k', e.k, 'c', xxhash64(e.k, {CHECK}), 'm', {_mask('e.h', width)}, 't', {table}))"


def _add(cell: str, found: str, place: str, sign: str) -> str:
    """The cell with all entries of ``found`` that lie at ``place`` put in (+) or taken out (-)."""
    return (f"aggregate({found}, {cell}, (a, e) -> IF((e.m & {place}) = 0L, a, "
            f"named_struct('n', a.n {sign} e.n, 'k', a.k ^ e.k, 'c', a.c ^ e.c)))")


def sketch(found: str, width: int) -> str:
    """Cells (n, k, c) of three rows of ``width``."""
    return f"transform({_places(width)}, place -> {_add(NONE, found, 'place', '+')})"


def subtract(ours: str, theirs: str) -> str:
    """The difference of two sketches of one size, cell by cell."""
    return f"zip_with({ours}, {theirs}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"


def _open(cells: str) -> str:
    return f"exists({cells}, x -> x.n != 0 OR x.k != 0L OR x.c != 0L)"


def peel(cells: str, width: int, seed: int) -> str:
    """(added, removed, left): digests recovered with count 1 and -1, and whether cells stay that hold some."""
    single = f"array_distinct(filter(s.cells, x -> abs(x.n) = 1 AND xxhash64(x.k, {CHECK}) = x.c))"
    pure = f"transform({single}, p -> named_struct('n', p.n, 'k', p.k, 'c', p.c, 'm', {_mask(f'xxhash64(p.k, {seed})', width)}))"
    without = f"zip_with(s.cells, {_places(width)}, (x, place) -> {_add('x', 'found', 'place', '-')})"
    added, removed = (f"concat(s.{c}, transform(filter(found, p -> p.n = {n}), p -> p.k))" for c, n in (("added", 1), ("removed", -1)))
    more = f"IF(size(found) = 0, s, named_struct('cells', {without}, 'added', {added}, 'removed', {removed}))"
    none = "CAST(array() AS ARRAY<BIGINT>)"
    start = f"named_struct('cells', {cells}, 'added', {none}, 'removed', {none})"
    steps = f"aggregate(sequence(1, {ROUNDS}), {start}, (s, i) -> IF({_open('s.cells')}, {let(pure, 'found', more)}, s))"
    return let(steps, "s", f"named_struct('added', s.added, 'removed', s.removed, 'left', {_open('s.cells')})")


def expected(cells: str, ours: str, theirs: str) -> str:
    """About how many digests differ, from the difference of two fingerprints and the numbers of digests of both versions.

    Each row's sum of squared counts is expected to be d + (net^2 - d) / BASE for d differing digests, net of them
    more in one version than in the other.
    """
    net = f"CAST({ours} - {theirs} AS DOUBLE)"
    squares = f"aggregate({cells}, 0D, (a, x) -> a + CAST(x.n AS DOUBLE) * x.n) / 3"
    return f"least(greatest(({squares} - {net} * {net} / {BASE}) / {1 - 1 / BASE}D, abs({net}), 1D), CAST({ours} + {theirs} AS DOUBLE))"


def fingerprint(cells: str) -> str:
    """A sketch as text: count, digests and check values of each cell in hex."""
    return f"lower(array_join(transform({cells}, x -> concat(lpad(hex(x.n), 8, '0'), lpad(hex(x.k), 16, '0'), lpad(hex(x.c), 16, '0'))), ''))"


def _join(parts: str) -> str:
    """The results of several tables as one."""
    added, removed = (f"flatten(transform({parts}, p -> p.{c}))" for c in ("added", "removed"))
    return f"named_struct('added', {added}, 'removed', {removed}, 'left', exists({parts}, p -> p.left))"


def _recover(ours: str, theirs: str, seed: int) -> str:
    """A table's difference from the entries of both versions: sketched, subtracted, peeled."""
    return let(subtract(sketch(ours, CELLS), sketch(theirs, CELLS)), "cells", peel("cells", CELLS, seed))


def _of_table(both: str, table: str) -> str:
    return f"named_struct('o', filter({both}.o, e -> e.t = {table}), 't', filter({both}.t, e -> e.t = {table}))"


def _halves(both: str, seed: int) -> str:
    """The same with twice the cells: the digests are dealt by one more bit, under other hashes."""
    again = [entries(f"transform({both}.{c}, e -> e.k)", CELLS, seed, "2L") for c in ("o", "t")]
    parts = f"transform(array(0L, 1L), half -> {let(_of_table('split', 'half'), 'own', _recover('own.o', 'own.t', seed))})"
    return let(f"named_struct('o', {again[0]}, 't', {again[1]})", "split", let(parts, "parts", _join("parts")))


def difference(ours: str, theirs: str, tables: str, seed: int) -> str:
    """(added, removed, left) of two versions' digests by sketches of ``tables`` tables; a table that fails is made again as two."""
    made = let(_recover("mine.o", "mine.t", seed), "d", f"IF(NOT d.left, d, {_halves('mine', seed + 1)})")
    each = f"transform(sequence(0L, {tables} - 1L), t -> {let(_of_table('both', 't'), 'mine', made)})"
    both = f"named_struct('o', {entries(ours, CELLS, seed, tables)}, 't', {entries(theirs, CELLS, seed, tables)})"
    return let(let(both, "both", each), "each", _join("each"))


def differences(pairs: DataFrame, group: int = GROUP) -> DataFrame:
    """``pairs`` (pair: any id, ours, theirs: arrays of different digests, tables, whole) to (pair, added, removed, n_added): arrays of the
    digests that only ours and only theirs hold, by sketches of ``tables`` tables at first and of twice as many after each failure.
    Pairs whose ``whole`` is false get the number alone."""
    waiting = pairs.selectExpr("pair", "whole", "ours", "theirs", "CAST(tables AS BIGINT) AS tables")
    for level in range(4):  # FAN ** 4 groups of a pair, more than a text has paragraphs; 1 group is passed through
        dealt = [f"filter({c}, k -> pmod(xxhash64(k, {100 + level}), _n) = i) AS {c}" for c in ("ours", "theirs")]
        split = f"IF(_n = 1L, array(struct(ours, theirs)), transform(sequence(0L, _n - 1L), i -> struct({', '.join(dealt)})))"
        waiting = waiting.withColumn("_n", F.expr(f"least({FAN}L, CAST(ceil(tables / {group}) AS BIGINT))"))
        waiting = waiting.selectExpr("pair", "whole", "CAST(ceil(tables / _n) AS BIGINT) AS tables", f"explode({split}) AS g")
        waiting = waiting.selectExpr("pair", "whole", "g.ours", "g.theirs", "tables")
    done, seed = None, 11
    while True:
        # the result is used twice, so it is written once; groups that failed go on with their digests
        tried = waiting.withColumn("d", F.expr(difference("ours", "theirs", "tables", seed)))
        failed = F.col("d.left")
        tried = stage(tried.select(
            "pair", "whole", "tables", F.col("d.left").alias("left"), F.size("d.added").alias("n_added"),
            *[F.when(F.col("whole") & ~failed, F.col(f"d.{c}")).alias(c) for c in ("added", "removed")],
            *[F.when(failed, F.col(c)).alias(c) for c in ("ours", "theirs")]), "peeled")
        failed = F.col("left")
        good = tried.where(~failed).select("pair", "n_added", "added", "removed")
        done = good if done is None else done.unionByName(good)
        if not tried.where(failed).limit(1).count():
            return done.groupBy("pair").agg(
                F.sum("n_added").cast("int").alias("n_added"), *[F.flatten(F.collect_list(c)).alias(c) for c in ("added", "removed")])
        seed += 2
        waiting = tried.where(failed).select("pair", "whole", "ours", "theirs", (F.col("tables") * 2).alias("tables"))


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def with_next(docs: DataFrame, doc_id: str, text: str = "text", ranges: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``docs`` with _next: a struct of the text of the next row by id (after the last: the first).

    Ids with more rows than a range should have, and more than ``hot_rows``, are cut further by the hash of the text.
    """
    order_id = F.coalesce(F.col(doc_id).cast("long"), _long(NULL))
    ranges = ranges or min(max(64, input_bytes(docs) // RANGE_BYTES), MAX_RANGES)
    ids = docs.select(order_id.alias("_o"))
    cuts = ids.where(F.col("_o") != NULL).approxQuantile("_o", [i / ranges for i in range(1, ranges)] or [0.5], 0.2 / ranges)
    total = ids.count()
    counts = ids.groupBy("_o").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(hot_rows, total // ranges))
    hot = {r["_o"]: -(-r["n"] * ranges // total) for r in counts.collect()}  # at most one a range
    cuts = sorted({int(c) for c in cuts} | set(hot) | {o + 1 for o in hot})  # a hot id has a place alone
    place = F.size(F.filter(F.array(*[_long(c) for c in cuts]), lambda c: c <= F.col("_o"))) if cuts else F.lit(0)
    parts = F.array(*[_long(hot.get(c, 1)) for c in (None, *cuts)])
    share = F.shiftright("_t", 32) + _long(1 << 31)  # the hash's upper half, in its order
    rows = docs.withColumn("_o", order_id).withColumn("_t", F.xxhash64(F.col(text))).withColumn("_place", place)
    rows = rows.withColumn("_part", F.shiftright(share * parts[F.col("_place")], 32)).withColumn("_copy", F.lit(False))
    least = rows.groupBy("_place", "_part").agg(F.min(F.struct("_o", "_t")).alias("_least")).collect()  # one row a range
    heads = sorted((r["_place"], r["_part"], r["_least"]["_o"], r["_least"]["_t"]) for r in least)
    before = [(*heads[i], *heads[i - 1][:2]) for i in range(len(heads))]
    before = docs.sparkSession.createDataFrame(before, "_place int, _part long, _o long, _t long, _to int, _to_part long")
    one = Window.partitionBy("_place", "_part").orderBy("_t")
    # one row of each range, and only the columns that go on
    first = rows.join(F.broadcast(before), ["_place", "_part", "_o", "_t"]).withColumn("_n", F.row_number().over(one)).where("_n = 1")
    first = first.select(F.col("_to").alias("_place"), F.col("_to_part").alias("_part"), "_o", "_t", F.lit(True).alias("_copy"), text)
    rows = rows.unionByName(first, allowMissingColumns=True).repartition(max(1, len(heads)), "_place", "_part")  # tasks follow the input
    by = Window.partitionBy("_place", "_part").orderBy("_copy", "_o", "_t")
    rows = rows.withColumn("_next", F.lead(F.struct(text)).over(by))
    return rows.where(~F.col("_copy")).drop("_o", "_t", "_place", "_part", "_copy")


def likeness(ours: Column, theirs: Column, added: Column) -> Column:
    """Common digests among all, from the numbers of each and those only in ours."""
    common = ours - added
    return F.when(ours + theirs == 0, 1.0).otherwise(common / (ours + theirs - common))


def _first_tries(ours: str, theirs: str, cells: str) -> str:
    """(added, removed, left, tables) of two versions: by their fingerprints' difference ``cells``, then by sketches of the size that it tells."""
    def ended(d: str, tables: str) -> str:
        return f"named_struct('added', {d}.added, 'removed', {d}.removed, 'left', {d}.left, 'tables', {tables})"

    tables = f"greatest(1L, CAST(ceil({expected('base', f'size({ours})', f'size({theirs})')} * 1.25D / {SHARE}) AS BIGINT))"
    larger = let(tables, "n", f"IF(n > {TABLES}L, {ended('first', 'n')}, {let(difference(ours, theirs, 'n', 1), 'second', ended('second', 'n * 4L'))})")
    return let(cells, "base", let(peel("base", BASE, 0), "first", f"IF(NOT first.left, {ended('first', '0L')}, {larger})"))


def compare(docs: DataFrame, keep: Sequence[str] = ("doc_id",), doc_id: str = "doc_id") -> DataFrame:
    """Columns ``keep``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of all rows, and the
    digests (hex, comma-joined, ascending) of the paragraphs that the edit removed and added.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many of the next document.
    """
    kept = [f"_k{i}" for i in range(len(keep))]
    frame = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"),
                        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)])
    frame = with_next(frame, "_id", "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("_next.text"), half))
    frame = frame.select(
        *kept, F.monotonically_increasing_id().alias("_row"), n.cast("long").alias("n_chars"), digests(F.col("text")).alias("a"), digests(F.col("_next.text")).alias("x"),
        F.transform(F.array(edited), lambda e: F.struct(F.sha2(e, 256).alias("sha"), digests(e).alias("keys")))[0].alias("_e"),
    ).select("*", F.col("_e.keys").alias("e"), F.col("_e.sha").alias("edited_sha256")).drop("_e")
    cells = ", ".join(f"'{c}', {let(entries(c, BASE, 0), 'all', sketch('all', BASE))}" for c in ("a", "e", "x"))
    tries = [_first_tries("a", c, subtract("c.a", f"c.{c}")) for c in ("e", "x")]
    tried = F.expr(let(f"named_struct({cells})", "c", (
        f"named_struct('fingerprint', {fingerprint('c.a')}, 'edited_fingerprint', {fingerprint('c.e')}, 'e', {tries[0]}, 'x', {tries[1]})")))
    left = F.col("_d.e.left") | F.col("_d.x.left")
    rows = frame.withColumn("_d", tried).select(
        *kept, "_row", "n_chars", F.unhex("edited_sha256").alias("edited_sha256"),
        *[F.unhex(f"_d.{c}").alias(c) for c in ("fingerprint", "edited_fingerprint")],  # half the bytes of the text
        *[F.size(c).alias(f"_n{c}") for c in ("a", "e", "x")], *[F.col(f"_d.{c}.{f}").alias(f"_{c}_{f}") for c in ("e", "x") for f in ("left", "tables")],
        F.col("_d.e.added").alias("_e_added"), F.col("_d.e.removed").alias("_e_removed"), F.size("_d.x.added").alias("_x_added"),
        *[F.when(left, F.col(c)).alias(c) for c in ("a", "e", "x")])
    rows = stage(rows, "versions")

    left = F.col("_e_left") | F.col("_x_left")
    pairs = [rows.where(F.col(f"_{c}_left")).select((F.col("_row") * 2 + i).alias("pair"), F.col("a").alias("ours"), F.col(c).alias("theirs"),
             F.col(f"_{c}_tables").alias("tables"), F.lit(c == "e").alias("whole")) for i, c in enumerate(("e", "x"))]
    found = differences(pairs[0].unionByName(pairs[1]))
    later = found.groupBy(F.shiftright("pair", 1).alias("_pair")).agg(*[
        F.max(F.when(F.col("pair") % 2 == i, F.col(c))).alias(name)
        for i, c, name in ((0, "added", "_ea"), (0, "removed", "_er"), (1, "n_added", "_xa"))])
    mended = rows.where(left).join(later, F.col("_row") == F.col("_pair")).withColumns({
        "_e_added": F.when(F.col("_e_left"), F.col("_ea")).otherwise(F.col("_e_added")),
        "_e_removed": F.when(F.col("_e_left"), F.col("_er")).otherwise(F.col("_e_removed")),
        "_x_added": F.when(F.col("_x_left"), F.col("_xa")).otherwise(F.col("_x_added"))}).select(*rows.columns)

    def spell(keys: Column) -> Column:
        return F.array_join(F.array_sort(F.transform(keys, lambda k: F.lower(F.lpad(F.hex(k), 16, "0")))), ",")

    return rows.where(~left).unionByName(mended).select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)], "n_chars", *[F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
        likeness(F.col("_na"), F.col("_ne"), F.size("_e_added")).alias("near_edited"), likeness(F.col("_na"), F.col("_nx"), F.col("_x_added")).alias("near_next"),
        spell(F.col("_e_added")).alias("removed_paragraphs"), spell(F.col("_e_removed")).alias("added_paragraphs"))
