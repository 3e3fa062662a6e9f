"""Line dedup by a log-template tree (after Drain; native).

A line's tokens are split at white space, and tokens with a digit become ``<*>``.  The
tree has a fixed depth: a leaf holds the lines with the same number of tokens and the same
``LEAD`` first tokens.  A leaf's first template keeps, at each position, the token that
more than half of its different lines have there and has a variable field
elsewhere; a line belongs to the template if at least ``SIMILAR`` of its tokens are
the template's.  The lines it leaves gather in any number of further templates: each is
reduced to its most frequent tokens (as many as ``SIMILAR`` asks for and one more), and
lines that agree in all of these but one share a template.  A line joins its largest
template; rounds go on, with the tokens counted anew, until no template recurs.  Lines
outside all templates are templates of their own.

A template recurs if it occurs in different documents and its documents times its
tokens reach ``EVIDENCE`` (so a long passage recurs in two documents, a line of
four tokens in ten, and one of a single token in forty).  In scripts without blanks
characters count instead of tokens, if there are more of them.  A passage of neighbouring
lines (blank ones aside) that the same documents share recurs as a line of all its tokens
would, whatever lines it is wrapped into.  Recurring lines are
dropped from all documents but the first (the smallest id), so nothing is lost
altogether; blank lines stay.

Only hashes, positions and ids of lines are shuffled to find templates; whole texts
move once, when the lines to drop meet their documents.

Defined cases: a null text stays null and an empty one empty; documents are told
apart by id, so lines shared by rows of one id alone don't recur; a row without an id
counts as no document and is never the first; rows that repeat id and text are
treated alike; extra columns are carried along by ``drop_recurring_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.llm.storage import save

LEAD, LEAST_VARIABLE, EVIDENCE = 4, 6, 40
#: SIMILAR as a fraction of integers: 3 of 4 tokens.
SIMILAR = (3, 4)
#: White space within lines.
BLANKS = " \t\x0B\f\r"
#: Scripts without blanks between words, and their punctuation.
UNSPACED = (r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
            r"\u3001-\u303F\uFF01-\uFF65]")
KEY = ["leaf", "h1", "h2", "size"]


def canonical_line(line: Column) -> Column:
    """The line's tokens with one blank between, those with a digit as ``<*>``.

    A token of a script without blanks keeps all but its digits, and a line of under
    ``LEAD`` tokens that all have digits stays as it is.
    """
    tokens = F.filter(F.split(line, f"[{BLANKS}]+"), lambda t: t != "")
    odd = line.startswith(" ") | line.endswith(" ") | (F.instr(line, "  ") > 0) | line.rlike(f"[0-9{BLANKS[1:]}]")
    bare = ~line.rlike(f"(^|[{BLANKS}])[^0-9{BLANKS}]+([{BLANKS}]|$)") & (F.size(tokens) < LEAD) & ~line.rlike(UNSPACED)
    masked = F.transform(tokens, lambda t: F.when(~t.rlike("[0-9]"), t).when(
        (F.octet_length(t) > F.length(t)) & t.rlike(UNSPACED), F.regexp_replace(t, "[0-9]+", "<*>")).otherwise("<*>"))
    # most lines are canonical already, and are looked at once
    return F.when(~odd, line).when(bare, F.array_join(tokens, " ")).otherwise(F.array_join(masked, " "))


def _nonblank(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(BLANKS)) != "")


def _row_key(id_col: str, text_col: str) -> list[Column]:
    return [F.xxhash64(id_col, F.col(id_col).isNull(), text_col).alias("k1"),
            F.xxhash64(text_col, id_col, F.lit(1)).alias("k2")]


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, k1, k2, pos, size, h1, h2, leaf)`` of canonical lines.

    ``pos``: the line's place among those that aren't blank; ``size``: the tokens, or the characters of scripts without blanks; ``leaf``: null if the
    line has too few tokens for a variable field.
    """
    # canonical before the explode: a column that is inlined later would be computed again; in most texts all lines are
    text = F.col(text_col)
    odd = text.startswith(" ") | text.endswith(" ") | text.contains("\n ") | text.contains(" \n") | text.contains("  ") \
        | text.rlike(f"[0-9{BLANKS[1:]}]")
    lines = F.when(odd, F.transform(F.split(text, "\n", -1), canonical_line)).otherwise(F.split(text, "\n", -1))
    lines = docs.select(F.col(id_col).alias("id"), *_row_key(id_col, text_col), F.posexplode(
        F.filter(lines, lambda x: x != "")).alias("pos", "line"))
    lines = lines.withColumn(
        "n", F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    # such characters take three bytes or more: most lines are told without looking at each
    wide = F.length("line") - F.length(F.regexp_replace("line", UNSPACED, ""))
    size = F.when(F.octet_length("line") - F.length("line") > 2 * F.col("n"), F.greatest("n", wide)).otherwise(F.col("n"))
    return lines.select(
        "id", "k1", "k2", "pos", size.alias("size"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
        F.when(F.col("n") >= LEAST_VARIABLE, F.xxhash64("n", F.substring_index("line", " ", LEAD))).alias("leaf"))


def recurring_lines(docs: DataFrame, places: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(h1, h2, first)``: lines of recurring templates and the template's first document,
    and with a null ``first`` the other lines that different documents share.

    ``places``: a table of the documents' ``line_rows``.
    """
    across = (F.col("first") != F.col("last")) & (F.col("evidence") >= EVIDENCE)
    kinds = save(places.select(*KEY, "id").distinct().groupBy(*KEY).agg(
        (F.count("id") * F.col("size")).alias("evidence"), F.min("id").alias("first"), F.max("id").alias("last")), "line-kinds")
    leaves = kinds.filter(F.col("leaf").isNotNull()).groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds"), *_summed()) \
        .filter((F.col("kinds") > 1) & across).select("leaf", "kinds")
    wanted = save(kinds.filter(F.col("first").isNotNull()).join(leaves, "leaf"), "line-leaves")
    # one occurrence of each different line of such leaves: its place first, then hashes of its tokens in their
    # places; the first LEAD are all lines' in the leaf
    chosen = save(places.join(wanted.select(*KEY, "kinds", F.col("first").alias("id")), [*KEY, "id"]).groupBy(*KEY).agg(
        F.first("kinds").alias("kinds"), F.min(F.struct("k1", "k2", "pos")).alias("at")).select(*KEY, "kinds", "at.*"), "line-chosen")
    tokens = F.split(canonical_line(F.col("line")), " ")
    held = save(docs.select(*_row_key(id_col, text_col), F.posexplode(_nonblank(F.col(text_col))).alias("pos", "line")).join(
        chosen, ["k1", "k2", "pos"]).dropDuplicates(KEY).select(*KEY, "kinds", tokens.alias("tokens")).select(
            *KEY, "kinds", F.size("tokens").alias("n"), F.slice(F.transform("tokens", lambda t, at: F.xxhash64(at, t)), LEAD + 1, 1 << 30)
            .alias("spots")), "line-held")
    common = held.select("leaf", "kinds", F.explode("spots").alias("spot")).groupBy("leaf", "spot").agg(
        F.count(F.lit(1)).alias("c"), F.first("kinds").alias("kinds")).filter(2 * F.col("c") > F.col("kinds")) \
        .groupBy("leaf").agg(F.collect_list("spot").alias("template"))
    members = held.join(common, "leaf").filter(
        SIMILAR[1] * (LEAD + F.size(F.array_intersect("spots", "template"))) >= SIMILAR[0] * F.col("n")).select(*KEY)
    members = save(wanted.join(members, KEY).select(*KEY, "evidence", "first", "last"), "line-members")
    templates = members.groupBy("leaf").agg(*_summed()).filter(across) \
        .select("leaf", F.col("first").alias("t_first"))
    varied = save(members.join(templates, "leaf").select(*KEY, F.col("t_first").alias("first")), "line-varied")
    rest = wanted.join(varied.select(*KEY), KEY, "left_anti").select(*KEY, "evidence", "first", "last")
    while True:
        # leaves whose lines could recur together; every round takes lines out of them
        rest = save(rest, "line-rest")
        enough = rest.groupBy("leaf").agg(F.count(F.lit(1)).alias("lines"), *_summed()).filter(
            across & (F.col("lines") > 1)).select("leaf")
        left = save(held.drop("kinds").join(rest.join(enough, "leaf"), KEY).select(
            *KEY, "evidence", "first", "last", "n", F.explode("spots").alias("spot")), "line-left")
        if left.isEmpty():
            break
        more = save(_gathered(left, across), "line-varied")
        if more.isEmpty():
            break
        varied = varied.union(more)
        rest = rest.join(more.select(*KEY), KEY, "left_anti")
    shared = kinds.filter(F.col("first") != F.col("last")).select("h1", "h2", F.when(across, F.col("first")).alias("first"))
    return varied.select("h1", "h2", "first").union(shared) \
        .groupBy("h1", "h2").agg(F.min("first").alias("first"))


def _summed() -> list[Column]:
    return [F.sum("evidence").alias("evidence"), F.min("first").alias("first"), F.max("last").alias("last")]


def _gathered(left: DataFrame, across: Column) -> DataFrame:
    """``(*KEY, first)`` of the lines that gather in recurring templates, each in its largest.

    ``left``: a row per line and token, without the ``LEAD`` tokens that a leaf's lines share.
    """
    counts = left.groupBy("leaf", "spot").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
    ranked = left.join(counts, ["leaf", "spot"]).groupBy(*KEY, "n", "evidence", "first", "last").agg(
        F.sort_array(F.collect_list(F.struct("c", "spot")), asc=False)["spot"].alias("spots"))
    need = (F.col("n") * SIMILAR[0] + SIMILAR[1] - 1 - (F.col("n") * SIMILAR[0] + SIMILAR[1] - 1) % SIMILAR[1]) / SIMILAR[1] - LEAD
    ranked = ranked.withColumn("need", need.cast("int")).filter(F.size("spots") >= F.col("need")) \
        .withColumn("top", F.slice("spots", F.lit(1), F.col("need") + 1))
    # a template is the xor of its tokens' hashes: all but one of the top tokens, or just as many as are shared
    whole = F.aggregate("top", F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))
    ranked = ranked.withColumn("whole", whole).withColumn("out", F.when(
        F.size("top") > F.col("need"), F.col("top")).otherwise(F.array(F.lit(0).cast("bigint"))))
    variants = save(ranked.select(*KEY, "evidence", "first", "last", "whole", F.explode("out").alias("out")).select(
        *KEY, "evidence", "first", "last", F.col("whole").bitwiseXOR(F.col("out")).alias("variant")), "line-variants")
    found = variants.groupBy("leaf", "variant").agg(*_summed()).filter(across) \
        .select("leaf", "variant", F.col("evidence").alias("weight"))
    taken = variants.join(found, ["leaf", "variant"]).groupBy(*KEY, "evidence", "first", "last").agg(
        F.max(F.struct("weight", "variant"))["variant"].alias("variant"))
    taken = save(taken, "line-taken")
    kept = taken.groupBy("leaf", "variant").agg(*_summed(), F.count(F.lit(1)).alias("lines")) \
        .filter(across & (F.col("lines") > 1)).select("leaf", "variant", F.col("first").alias("t_first"))
    return taken.join(kept, ["leaf", "variant"]).select(*KEY, F.col("t_first").alias("first"))


def recurring_passages(hits: DataFrame) -> DataFrame:
    """``(k1, k2, pos)`` of lines in recurring passages, but for those of a passage's first document.

    ``hits``: the places of shared lines.  Passages are the runs of neighbouring lines that reach
    the evidence in two documents only with both their ends, and all shorter ones.
    """
    enough = -(-EVIDENCE // 2)
    row = Window.partitionBy("k1", "k2").orderBy("pos")
    near = hits.select("id", "k1", "k2", "pos", "size", F.xxhash64("h1", "h2").alias("h"), F.col("first").isNull().alias("weak")).distinct()
    # runs of neighbours with a line that doesn't recur by itself
    near = near.withColumn("run", F.col("pos") - F.row_number().over(row))
    near = near.withColumn("any", F.max("weak").over(Window.partitionBy("k1", "k2", "run"))).filter("any")
    ahead = Window.partitionBy("k1", "k2", "run").orderBy("pos").rowsBetween(0, enough)
    near = near.select("id", "k1", "k2", "pos", F.collect_list(F.struct("size", "h", "weak")).over(ahead).alias("lines")) \
        .filter(F.size("lines") > 1)
    step = F.struct(F.lit(0).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("first"), F.lit(0).cast("bigint").alias("last"),
                    F.lit(0).cast("bigint").alias("d1"), F.lit(1).cast("bigint").alias("d2"), F.lit(0).alias("n"), F.lit(False).alias("weak"))
    # all beginnings of the run, each from the one before
    grown = F.aggregate("lines", F.array(step), lambda done, x: F.concat(done, F.array(F.struct(
        (F.element_at(done, -1)["size"] + x["size"]).alias("size"),
        F.when(F.size(done) == 1, x["size"]).otherwise(F.element_at(done, -1)["first"]).cast("bigint").alias("first"),
        x["size"].cast("bigint").alias("last"), F.xxhash64(F.element_at(done, -1)["d1"], x["h"]).alias("d1"),
        F.xxhash64(x["h"], F.element_at(done, -1)["d2"]).alias("d2"), F.size(done).alias("n"),
        (F.element_at(done, -1)["weak"] | x["weak"]).alias("weak")))))
    passages = save(near.select("id", "k1", "k2", "pos", F.explode(grown).alias("p")).select("id", "k1", "k2", "pos", "p.*").filter(
        (F.col("n") > 1) & F.col("weak") & (F.col("size") - F.greatest("first", "last") < enough)).drop("first", "last", "weak"), "passages")
    known = passages.select("d1", "d2", "size", "id").distinct().groupBy("d1", "d2", "size").agg(
        F.count("id").alias("docs"), F.min("id").alias("first"), F.max("id").alias("last")) \
        .filter((F.col("first") != F.col("last")) & (F.col("docs") * F.col("size") >= EVIDENCE)).select("d1", "d2", "first")
    return passages.join(known, ["d1", "d2"]).filter(~F.col("id").eqNullSafe(F.col("first"))) \
        .select("k1", "k2", F.explode(F.sequence("pos", F.col("pos") + F.col("n") - 1)).alias("pos"))


def _with_gone(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(row, text, gone)`` of every row: itself, its text and the places of its recurring lines, or null."""
    places = save(line_rows(docs, id_col, text_col), "line-places")
    repeats = save(recurring_lines(docs, places, id_col, text_col), "recurring")
    hits = save(places.drop("leaf").join(repeats, ["h1", "h2"]), "line-hits")
    alone = hits.filter(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).select("k1", "k2", "pos")
    gone = alone.union(recurring_passages(hits)).groupBy("k1", "k2").agg(F.collect_set("pos").alias("gone"))
    k1, k2 = _row_key(id_col, text_col)
    return docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), k1, k2).join(
        gone, ["k1", "k2"], "left").drop("k1", "k2")


def _cleaned(found: DataFrame, columns: list[str], text_col: str, counts: tuple[str, ...] = ()) -> DataFrame:
    """``columns`` of the rows of ``_with_gone`` with cleaned texts, and the numbers of all and of dropped lines under
    the names ``counts``."""
    # split once: an expression that is used twice stays a column of its own
    found = found.withColumn("lines", F.split("text", "\n", -1))
    found = found.withColumn("at", F.when(F.col("gone").isNotNull(), F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("lines", i).rlike(f"[^{BLANKS}]"))))
    places_gone = F.when(F.size("at") > 0, F.transform("gone", lambda g: F.get("at", g)))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), places_gone),
                       lambda i: F.get("lines", i))
    cleaned = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    values = (F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), F.lit(0)),
              F.coalesce(F.size("gone"), F.lit(0)))
    return found.select(*[cleaned.alias(c) if c == text_col else F.col("row")[c].alias(c)
                          for c in columns if c not in counts],
                        *[v.cast("bigint").alias(c) for c, v in zip(counts, values)])


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with cleaned texts and two counts (which replace columns of their names)."""
    return _cleaned(_with_gone(docs, id_col, text_col), docs.columns, text_col, (n_lines, n_dropped))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without recurring lines; a document that had nothing else goes."""
    # told before the texts are put together: a filter on the cleaned text would build it again for each of its lines
    whole = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{BLANKS}]"))
    found = _with_gone(docs, id_col, text_col).filter(F.col("gone").isNull() | (F.size("gone") < F.size(whole)))
    return _cleaned(found, docs.columns, text_col)
