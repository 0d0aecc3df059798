"""One consistent form for texts that look the same.

Texts that hold no special character are their own form (a check, not a sample: the set of special
characters is exactly those whose form differs, and all combining marks). The others are exploded to
positioned pieces: a special character, a character with the marks that attach to it, or a stretch that
no rule touches. Characters that stand alone are joined with the broadcast mapping of their decomposed
and recomposed forms and look-alikes. Every different character with marks is exploded to positioned
code points, which are joined with the broadcast mapping of decompositions and look-alikes; marks are
ordered by class and recomposed; these forms are joined back. Then the texts are put together again.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm import lookalikes as la
from plumbline.operators.skew import join_hot
from plumbline.session import cut

SALTS = 16
#: More different pieces than this are joined by a shuffle with the most frequent ones broadcast.
BROADCAST_PIECES = 100_000


def _blocks(*ranges: tuple[int, int], special: bool) -> str:
    """The special, or the other, characters of frequent blocks, as the inside of a short Java class."""
    known = set(la.special_characters())
    return la.java_class("".join(chr(c) for a, b in ranges for c in range(a, b) if (chr(c) in known) is special))


def _java_classes() -> tuple[str, str, str, str]:
    """Java classes: characters that no rule touches, special ones, attaching marks, marks or invisible characters.

    A long class costs a test for each of its hundreds of ranges, so short classes of frequent characters decide first.
    """
    special, marks, gone = (la.java_class(c) for c in (la.special_characters(), la.attaching_characters(), la.invisible_characters()))
    harmless = r"\n\x20-\x7E[" + _blocks((0xA0, 0x250), (0x2010, 0x2027), (0x20A0, 0x20C0), (0x2190, 0x222C), (0x4E00, 0xA000), special=False) + "]"
    frequent = _blocks((0xFF01, 0xFF5F), (0xA0, 0xC0), (0x2000, 0x2012), (0x370, 0x460), (0xFB00, 0xFB07), special=True)
    apart = r"\n\x20-\x7E[\xA0-\xAC\xAE-\x{2FF}\x{370}-\x{482}\x{2000}-\x{200A}\x{2010}-\x{2027}\x{FF01}-\x{FF5E}\x{4E00}-\x{9FFF}]"
    untouched = f"[{harmless}[[^{frequent}]&&[^{special}]]]"
    touched = f"[[^{harmless}]&&[{frequent}[{special}]]]"
    return untouched, touched, f"[[^{apart}]&&[{marks}]]", f"[[^{apart}]&&[{gone}{marks}]]"


def has_special(text: Column) -> Column:
    """Whether a text holds a special character."""
    return text.rlike(_java_classes()[1])


def pieces(text: Column) -> Column:
    """The text as an array of pieces: stretches that no rule touches, special characters, characters with their marks.

    A mark attaches to the character before it, be it across characters without a visible form.
    """
    untouched, _, mark, mark_or_gone = _java_classes()
    # loops over classes only: the length of a stretch costs no stack
    pattern = f"{untouched}+(?!{mark_or_gone}*{mark})|(?s:.){mark_or_gone}*{mark}|(?s:.)"
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))


def _mapping(spark: SparkSession) -> DataFrame:
    """ch, parts: fixed tables of the Unicode data (some thousand rows)."""
    rows = [(c, list(to)) for c, to in la.char_map().items()]
    return spark.createDataFrame(rows, "_ch string, _parts array<string>")


def _classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(la.mark_classes().items()), "_ch string, _class int")


def _compose(base: Column, marks: Column) -> Column:
    """base and its ordered marks (array of ch, class), composed as far as canonical composition goes."""
    pairs = la.compositions()
    table = F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")
    start = F.struct(base.alias("b"), F.lit("").alias("rest"), F.lit(0).alias("last"))

    def step(acc: Column, m: Column) -> Column:
        made = F.element_at(table, F.concat(acc["b"], m["_ch"]))
        free = (acc["last"] == 0) | (acc["last"] < m["_class"])
        return F.when(free & made.isNotNull(), F.struct(made.alias("b"), acc["rest"].alias("rest"), acc["last"].alias("last"))).otherwise(
            F.struct(acc["b"].alias("b"), F.concat(acc["rest"], m["_ch"]).alias("rest"), m["_class"].alias("last"))
        )

    return F.aggregate(marks, start, step, lambda acc: F.concat(acc["b"], acc["rest"]))


def canonical_text(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` (together unique), ``text`` and ``canonical``: one row per row with a non-null text.

    An empty text stays empty; a text of invisible characters becomes empty; line feeds are kept;
    letter case, accents, digits and punctuation are kept; several spaces are not one. Hangul
    syllables are taken apart into their letters. A very long text is one group of one task, as it is one row.
    """
    base = rows.select(*keys, F.col(text).alias(text)).where(F.col(text).isNotNull())
    flagged = cut(base.select(*keys, text, has_special(F.col(text)).alias("_odd")))
    plain = flagged.where("not _odd").select(*keys, text, F.col(text).alias("canonical"))
    odd = flagged.where("_odd").drop("_odd")
    return plain.unionByName(odd.join(_rebuilt(odd, keys, text), keys))


def _forms(distinct: DataFrame) -> DataFrame:
    """piece and canonical of each different piece (column ``piece``), by way of its code points."""
    spark = distinct.sparkSession
    # decomposition and look-alikes; a character without a visible form leaves a row without one
    points = distinct.select("piece", F.posexplode(F.split("piece", "")).alias("_pos", "_ch"))
    points = points.join(F.broadcast(_mapping(spark)), "_ch", "left")
    points = points.select("piece", "_pos", F.posexplode_outer(F.coalesce("_parts", F.array("_ch"))).alias("_sub", "_ch"))
    # combining marks belong to the run of the starter before them
    points = points.join(F.broadcast(_classes(spark)), "_ch", "left").withColumn("_class", F.coalesce("_class", F.lit(0)))
    in_piece = Window.partitionBy("piece").orderBy("_pos", "_sub")
    starts = F.when((F.col("_class") == 0) & F.col("_ch").isNotNull(), 1).otherwise(0)
    points = points.withColumn("_run", F.sum(starts).over(in_piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = points.groupBy("piece", "_run").agg(
        F.max(F.when(F.col("_class") == 0, F.col("_ch"))).alias("_base"),
        F.array_sort(F.collect_list(F.when(F.col("_class") > 0, F.struct("_class", "_pos", "_sub", "_ch")))).alias("_marks"),
    )
    bare = F.coalesce("_base", F.lit(""))
    made = F.when(F.size("_marks") == 0, bare).otherwise(_compose(bare, F.col("_marks")))
    return runs.groupBy("piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_run", made.alias("_s")))), lambda r: r["_s"]), "").alias("canonical"))


def _single_forms(spark: SparkSession) -> DataFrame:
    """piece and canonical of every special character that stands alone (a fixed table)."""
    return spark.createDataFrame([(c, la.fold(c)) for c in la.special_characters()], "piece string, _alone string")


def _rebuilt(odd: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``canonical`` of texts with special characters, one row per key.

    ``odd`` is read once for its pieces and, where a text holds a combining mark, once before that for its
    different characters with marks.
    """
    has_mark = lambda c: c.rlike(_java_classes()[2])
    with_marks = (F.length("piece") > 1) & has_mark(F.col("piece"))
    counted = cut(
        odd.where(has_mark(F.col(text))).select(F.explode(F.array_distinct(pieces(F.col(text)))).alias("piece")).where(with_marks).groupBy("piece").agg(F.count(F.lit(1)).alias("_n"))
    )
    forms = cut(counted.join(_forms(counted.select("piece")), "piece"))
    # texts are shuffled, not their pieces: all that follows keeps this partitioning
    points = odd.dropDuplicates(keys).select(*keys, F.posexplode(pieces(F.col(text))).alias("_pos", "_piece"))
    # stretches match no form; they do not meet in one task
    asked = (F.length("_piece") == 1) | has_mark(F.col("_piece"))
    points = points.withColumn("piece", F.when(asked, F.col("_piece")).otherwise(F.concat(F.lit("\x00\x00"), (F.col("_pos") % 4096).cast("string"))))
    points = points.join(F.broadcast(_single_forms(odd.sparkSession)), "piece", "left")
    if counted.count() <= BROADCAST_PIECES:
        joined = points.join(F.broadcast(forms.drop("_n")), "piece", "left")
    else:
        joined = join_hot(points, forms, "piece", "_n")
    part = F.struct("_pos", F.coalesce("_alone", "canonical", "_piece").alias("_s"))
    return joined.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda r: r["_s"]), "").alias("canonical"))


def lookalike_classes(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, ``exact`` and ``class_id``: the hash of each non-null text and of its canonical form; repeated rows count once."""
    base = rows.select(*keys, F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    # one scan: plain texts leave only their hash behind
    flagged = cut(base.select(*keys, F.md5("_text").alias("exact"), F.when(has_special(F.col("_text")), F.col("_text")).alias("_odd")))
    plain = flagged.where("_odd is null").select(*keys, "exact", F.col("exact").alias("class_id"))
    # keys are meant to be unique; the exact text is part of the key in case they are not
    odd = _rebuilt(flagged.where("_odd is not null"), [*keys, "exact"], "_odd").select(*keys, "exact", F.md5("canonical").alias("class_id"))
    return plain.unionByName(odd).distinct()


def class_links(classes: DataFrame, keys: list[str], group: list[str] = []) -> DataFrame:  # noqa: B006
    """``keys``, class_id, n_links: every row with its class and the number of rows that look the same but differ.

    Copies of a text are not linked with each other. Linear in the rows, whatever the size of a class.
    """
    per = [*group, "class_id"]
    texts = classes.groupBy(*per, "exact").agg(F.count(F.lit(1)).alias("_copies"))
    whole = texts.groupBy(*per).agg(F.sum("_copies").alias("_rows"))
    sizes = texts.join(whole, per).withColumn("n_links", F.col("_rows") - F.col("_copies")).select(*per, "exact", "_copies", "n_links")
    marked = classes.withColumn("_k", F.concat_ws("\x01", *group, "exact"))
    lookup = sizes.select(F.concat_ws("\x01", *group, "exact").alias("_k"), "n_links", "_copies")
    return join_hot(marked, lookup, "_k", "_copies").select(*keys, "class_id", "n_links")


def class_pairs(classes: DataFrame, id_col: str, group: list[str] = []) -> DataFrame:  # noqa: B006
    """``group``, id_a, id_b (id_a < id_b): all rows of one class with different texts.

    First the different texts of a class are paired, then each text becomes its rows, on one side after
    the other: copies are never compared with copies. Both steps are salted, so a text that a third of
    all rows hold is spread over tasks.
    """
    per = [*group, "class_id"]
    texts = classes.groupBy(*per, "exact").agg(F.count(F.lit(1)).alias("_copies"))
    several = texts.groupBy(*per).agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").select(*per)
    texts = texts.join(several, per)
    other = texts.select(*per, F.col("exact").alias("_other"), F.col("_copies").alias("_more"))
    # the text with more copies comes first and is spread, the other one is replicated to the salts
    both = texts.join(other, per).where((F.col("_copies") > F.col("_more")) | ((F.col("_copies") == F.col("_more")) & (F.col("exact") > F.col("_other"))))
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt")
    salt = F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int").alias("_salt")
    members = classes.select(*group, "exact", F.col(id_col).alias("_a"), salt)
    first = both.select(*group, "exact", "_other", salts).join(members, [*group, "exact", "_salt"]).select(*group, "_other", "_a", "_salt")
    second = classes.join(several, per, "left_semi").select(*group, F.col("exact").alias("_other"), F.col(id_col).alias("_b"), salts)
    pairs = first.join(second, [*group, "_other", "_salt"]).where("_a <> _b")
    return pairs.select(*group, F.least("_a", "_b").alias("id_a"), F.greatest("_a", "_b").alias("id_b")).distinct()


def lookalike_pairs(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id_a, id_b), id_a < id_b: rows whose texts look the same but differ in code points.

    All such pairs; copies of one text are no pair with each other. Null ids and texts have no pair;
    rows with equal ids and texts count once.
    """
    classes = cut(lookalike_classes(rows.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text).alias("_t")), ["_id"], "_t"))
    return class_pairs(classes, "_id")
