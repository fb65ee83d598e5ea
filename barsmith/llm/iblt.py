"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, DataFrame functions only.

A text's paragraphs are its lines; a line of more than 160 characters is cut at
the next end of a sentence.  Each is digested to 64 bits together with how often
it occurred before.  A sketch has ``strips``; a digest belongs to one strip and,
there, to one cell of each of three rows of eight.  A cell holds the number of
its digests, their exclusive or, and the exclusive or of their check hashes.

Two sketches are subtracted cell by cell, so common paragraphs vanish, and what
is left is peeled: a cell with one digest whose check agrees gives that digest
away, which is taken out of its other cells, until all cells are empty.  Then the
digests found are exactly the difference.  Where cells remain, both sketches are
made anew, larger and with other hashes: a strip for four digests; the digests of the
strips that do not peel then get a strip each, and again, until all have peeled.

The fingerprint of a text is its sketch of one strip, all cells in full.  The likeness
of two texts is the number of common paragraphs by that of all, which follows from the
counts and the recovered difference: that of the fingerprints where it peels, else
that of the larger sketches, which are made from the digests.

Defined cases: a null text is empty and has no paragraphs; two empty texts have
the likeness 1, an empty and another one 0; documents follow each other by id,
null ids first, equal ids by text; an only document follows itself; repeated rows
are documents each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.common import materialise

PARAGRAPH = r"[^\n]{160,}?[.!?](?=\s|$)|[^\n]+"
ROWS, WIDTH, ROUNDS = 3, 8, 12
#: Turns tried.
TURNS = 8
#: Documents in a stretch of the order of ids, and quantiles that place the stretches.
STRETCH, CELLS = 2_048, 64


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``value`` computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def digests_sql(text: str) -> str:
    """Sorted 64-bit digests of the paragraphs of a text; equal paragraphs are told apart by their number."""
    pieces = f"regexp_extract_all({text}, '{PARAGRAPH.replace(chr(92), chr(92) * 2)}', 0)"
    return _let("ps", f"sort_array(transform({pieces}, p -> xxhash64(p)))",
                "transform(ps, (h, i) -> xxhash64(h, i + 1 - array_position(ps, h)))")


#: A bit for each cell of a strip; a digest's cells are a mask.
BITS = "array(" + ", ".join(str(1 << at) for at in range(ROWS * WIDTH)) + ")"


def _mask(h: str) -> str:
    """The three cells of a digest, from its hash in a turn; every turn hashes anew."""
    return " | ".join(f"shiftleft(1, {WIDTH * row} + cast(shiftright({h}, {3 * row}) & {WIDTH - 1} AS int))" for row in range(ROWS))


def sketch_sql(keys: str, strips: str, turn: str) -> str:
    """Array of strips, each an array of ROWS * WIDTH cells (n, x, c).

    Digests go to their strips by way of about as many groups of strips as a group
    has, so that no digest is looked at for every strip.
    """
    hashed = f"transform(transform({keys}, k -> named_struct('k', k, 'h', xxhash64(k, {turn}))), e -> named_struct('k', e.k, 'c', xxhash64(e.k, 'check'), 'm', {_mask('e.h')}, 's', cast(pmod(shiftright(e.h, 20), {strips}) AS int)))"
    cell = ("aggregate(filter(own, e -> (e.m & bit) <> 0), "
            "named_struct('n', 0, 'x', 0L, 'c', 0L), (a, e) -> named_struct('n', a.n + 1, 'x', a.x ^ e.k, 'c', a.c ^ e.c))")
    strip = _let("own", "filter(es, e -> e.s = s)", f"transform({BITS}, bit -> {cell})")
    group = _let("es", "filter(every, e -> e.s div w = o)", f"transform(sequence(o * w, least(o * w + w, {strips}) - 1), s -> {strip})")
    groups = f"flatten(transform(sequence(0, cast(ceil({strips} / w) AS int) - 1), o -> {group}))"
    return _let("every", hashed, _let("w", f"cast(ceil(sqrt({strips})) AS int)", groups))


def subtract_sql(a: str, b: str) -> str:
    return (f"zip_with({a}, {b}, (sa, sb) -> zip_with(sa, sb, (p, q) -> "
            "named_struct('n', p.n - q.n, 'x', p.x ^ q.x, 'c', p.c ^ q.c)))")


def peel_sql(strip: str, turn: str) -> str:
    """Number of digests that a strip of a difference holds; -1 if it does not peel."""
    pure = "array_distinct(transform(filter(st.cells, c -> abs(c.n) = 1 AND c.c = xxhash64(c.x, 'check')), c -> named_struct('n', c.n, 'x', c.x)))"
    hashed = f"transform({pure}, k -> named_struct('n', k.n, 'x', k.x, 'c', xxhash64(k.x, 'check'), 'm', {_mask(f'xxhash64(k.x, {turn})')}))"
    out = (f"zip_with(st.cells, {BITS}, (c, bit) -> aggregate(filter(found, k -> (k.m & bit) <> 0), c, "
           "(a, k) -> named_struct('n', a.n - k.n, 'x', a.x ^ k.x, 'c', a.c ^ k.c)))")
    step = _let("found", hashed, f"if(size(found) = 0, named_struct('cells', st.cells, 'n', st.n, 'over', true), named_struct('cells', {out}, 'n', st.n + size(found), 'over', false))")
    loop = (f"aggregate(sequence(1, {ROUNDS}), named_struct('cells', {strip}, 'n', 0, 'over', false), "
            f"(st, i) -> if(st.over, st, {step}), st -> if(exists(st.cells, c -> c.n <> 0 OR c.x <> 0L OR c.c <> 0L), -1, st.n))")
    return loop


def _strip_of(k: str, strips: str, turn: str) -> str:
    return f"cast(pmod(shiftright(xxhash64({k}, {turn}), 20), {strips}) AS int)"


def difference_sql(a: str, b: str) -> str:
    """Number of digests in one of two sets only.

    The first turn has one strip, the next one a strip for four digests; the digests
    of the strips that did not peel go on to the next turn, with a strip for each.
    Should two digests share their cells in every turn, they are compared themselves.
    """
    counts = f"transform({subtract_sql(sketch_sql('st.a', 'g', 't'), sketch_sql('st.b', 'g', 't'))}, d -> {peel_sql('d', 't')})"
    stays = lambda keys: f"filter({keys}, k -> element_at(cs, {_strip_of('k', 'g', 't')} + 1) < 0)"
    step = _let("cs", counts, f"named_struct('a', {stays('st.a')}, 'b', {stays('st.b')}, 'n', st.n + aggregate(cs, 0, (u, c) -> u + greatest(c, 0)))")
    strips = "if(t = 0, 1, cast(greatest(4, (size(st.a) + size(st.b)) div if(t = 1, 4, 1)) AS int))"
    none = "cast(array() AS array<bigint>)"
    # a set of far more digests than cells cannot peel in one strip, nor can a difference that is larger than the cells
    turn = f"if(size(st.a) + size(st.b) = 0 OR (t = 0 AND abs(size(st.a) - size(st.b)) > {ROWS * WIDTH}), st, {_let('g', strips, step)})"
    rest = "st.n + size(array_except(st.a, st.b)) + size(array_except(st.b, st.a))"
    return f"aggregate(sequence(0, {TURNS - 1}), named_struct('a', coalesce({a}, {none}), 'b', coalesce({b}, {none}), 'n', 0), (st, t) -> {turn}, st -> {rest})"


def likeness(a: str, b: str) -> Column:
    """Common paragraphs by all paragraphs of two digest columns, from the peeled difference of their sketches."""
    n = f"(size({a}) + size({b}))"
    d = f"if({a} = {b}, 0, {difference_sql(a, b)})"
    return F.expr(f"CASE WHEN {n} = 0 THEN 1.0D ELSE " + _let("d", d, f"({n} - d) / cast({n} + d AS double)") + " END")


def fingerprint(keys: str) -> Column:
    """The sketch of one strip as text: the number of digests, then count, exclusive or and check of each cell, whole, in
    hexadecimal; two fingerprints can be subtracted and peeled."""
    cells = f"element_at({sketch_sql(keys, '1', '0')}, 1)"
    return F.expr(f"concat(size({keys}), ':', array_join(transform({cells}, c -> if(c.n = 0, '', concat_ws('.', hex(c.n), hex(c.x), hex(c.c)))), ','))")


def with_stretch(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with (cell, stretch): parts of the order of ids of about STRETCH documents each.

    Quantiles place the cells, whatever the ids are; within a cell ids are cut evenly.
    """
    n = docs.count()
    probes = [i / CELLS for i in range(CELLS + 1)]
    marks = sorted(set(docs.select(F.col(id_col).cast("double").alias("x")).where("x is not null").approxQuantile("x", probes, 0.001))) if n else []
    if len(marks) < 2:
        return docs.withColumns({"cell": F.lit(0), "stretch": F.lit(0).cast("long")})
    x = F.coalesce(F.col(id_col).cast("double"), F.lit(float("-inf")))
    edges = F.array(*map(F.lit, marks))
    cell = F.greatest(F.lit(1), F.least(F.lit(len(marks) - 1), F.size(F.filter(edges, lambda e: e <= x))))
    parts = max(1, round(n / CELLS / STRETCH))
    low, high = F.element_at(edges, F.col("cell")), F.element_at(edges, F.col("cell") + 1)
    part = F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor((x - low) / (high - low) * parts)))
    part = F.when(x == float("-inf"), F.lit(0)).otherwise(part)
    return docs.withColumn("cell", cell).withColumn("stretch", (F.col("cell") * F.lit(parts) + part).cast("long"))


def edit(text: str, following: str) -> Column:
    """The text whose last half, rounded down, is replaced by as much of the beginning of the following text."""
    half = f"length({text}) div 2"
    return F.expr(f"concat(left({text}, cast(length({text}) - {half} AS int)), left({following}, cast({half} AS int)))")


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, own, edited, following): digests of each text, of its edited text and of the next text.

    Texts move once, to the stretch of their id.  The last document of a stretch
    gets the first one of the next stretch, found among first documents only.
    """
    rows = with_stretch(docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "id")
    rows = rows.withColumn("own", F.expr(digests_sql("text")))
    order = Window.partitionBy("stretch").orderBy("id", "text")
    led = (rows.withColumn("after", F.lead(F.struct("text", "own")).over(order))
           .withColumn("is_first", F.lag(F.lit(True)).over(order).isNull()))
    is_last = F.col("after").isNull()

    def facts(df: DataFrame) -> DataFrame:
        changed = df.withColumn("e", edit("text", "after.text"))
        return changed.select("id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("e").cast("binary"), 256).alias("edited_sha256"), "own",
                              F.expr(digests_sql("e")).alias("edited"), F.col("after.own").alias("following"),
                              *[c for c in ("cell", "stretch", "is_first", "text") if c in df.columns])

    table = materialise(facts(led).withColumn("is_last", F.col("following").isNull())
                        .withColumn("text", F.when(F.col("is_first") | F.col("is_last"), F.col("text"))), "versions")
    first = table.where("is_first").select("cell", "stretch", "text", "own")
    # the next stretch that has documents: within the cell, else the first one of the next cell (at most CELLS rows)
    heads = first.select("cell", "stretch")
    cells = heads.groupBy("cell").agg(F.min("stretch").alias("head"))
    turn = cells.select("cell", F.coalesce(F.lead("head").over(Window.orderBy("cell")), F.min("head").over(Window.partitionBy(F.lit(0)))).alias("turn"))
    follow = (heads.withColumn("n", F.lead("stretch").over(Window.partitionBy("cell").orderBy("stretch"))).join(turn, "cell")
              .select("stretch", F.coalesce("n", "turn").alias("to")))
    after = first.select(F.col("stretch").alias("to"), F.struct("text", "own").alias("after"))
    last = (table.where("is_last").select("id", "text", "own", "stretch").join(follow, "stretch").join(after, "to").select("id", "text", "own", "after"))
    keep = ["id", "n_chars", "edited_sha256", "own", "edited", "following"]
    return table.where("not is_last").select(*keep).unionByName(facts(last).select(*keep))


def compare(pairs: DataFrame) -> DataFrame:
    """``versions`` rows -> fingerprints of both texts, likeness to the edited and to the next text."""
    # few bytes, much work: a given number of partitions is not coalesced by size
    pairs = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id", "edited_sha256")
    return pairs.select("id", "n_chars", "edited_sha256", fingerprint("own").alias("fingerprint"), fingerprint("edited").alias("edited_fingerprint"),
                        likeness("own", "edited").alias("near_edited"), likeness("own", "following").alias("near_next"))
