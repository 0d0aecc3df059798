"""What changed between full snapshots.

Every delivered generation is unpivoted into signed cells: a row adds its cells to the step into its
own generation (+1) and takes them from the step into the next delivered one (-1). A key-presence
marker travels with the cells. Cells that are equal on both sides cancel; what is left tells added,
removed and changed keys, and which fields changed. No join of snapshot with snapshot takes place;
the rows of a step meet in one exchange, after the repeats were taken out before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_GENERATIONS = 100_000


def latest_rows(snapshot: DataFrame) -> DataFrame:
    """One row per (generation, product_id): the one refreshed last.

    Repeated rows collapse; at equal ``refreshed_at`` the greater payload text counts; a null
    ``refreshed_at`` or payload counts as the smallest. Rows without generation or product_id
    belong to no product and are left out.
    """
    return (
        snapshot.select("generation", "product_id", "refreshed_at", "payload_json")
        .where(F.col("generation").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("generation", "product_id")
        .agg(F.max(F.struct("refreshed_at", "payload_json")).alias("_top"))
        .select("generation", "product_id", F.col("_top.payload_json").alias("payload_json"))
    )


def payload_cells(payload: F.Column) -> F.Column:
    """array<struct<field,value>> of the non-null top-level fields of a JSON object.

    Values are canonical JSON, so key order, spacing and escapes do not count and ``1`` differs from
    ``"1"``. Text that is no JSON object has no fields.
    """
    entries = F.map_entries(F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>"))
    cells = F.transform(entries, lambda e: F.struct(e["key"].alias("field"), F.to_json(e["value"]).alias("value")))
    return F.coalesce(
        F.filter(cells, lambda c: c["value"].isNotNull() & (c["value"] != F.lit("null"))),
        F.array().cast("array<struct<field:string,value:string>>"),
    )


def snapshot_changes(snapshot: DataFrame, max_generations: int = MAX_GENERATIONS) -> DataFrame:
    """(generation, product_id, change_kind, changed_fields) against the previous delivered generation.

    ``snapshot`` needs generation, product_id, payload_json and refreshed_at; other columns are not
    read. The first generation yields nothing, an empty table yields nothing. ``changed_fields`` is
    sorted; for added and removed rows it holds all non-null fields. The generation numbers (one per
    delivery) are collected under the bound ``max_generations``; the rows never are.
    """
    from plumbline.session import bounded_list

    spark = snapshot.sparkSession
    gens = bounded_list(snapshot, "generation", max_generations)
    steps = [
        (g, s, t)
        for i, g in enumerate(gens)
        for s, t in ((1, g if i else None), (-1, gens[i + 1] if i + 1 < len(gens) else None))
        if t is not None
    ]
    kind = snapshot.schema["generation"].dataType.simpleString()
    to = spark.createDataFrame(steps, f"generation {kind}, _sign int, _step {kind}")
    row = F.struct("refreshed_at", F.struct("payload_json").alias("p"))
    sides = (
        snapshot.select("generation", "product_id", "refreshed_at", "payload_json")
        .where(F.col("generation").isNotNull() & F.col("product_id").isNotNull())
        .join(F.broadcast(to), "generation")
        .groupBy("_step", "product_id")
        .agg(*[F.max(F.when(F.col("_sign") == sign, row)).getField("p").alias(side) for side, sign in (("_new", 1), ("_old", -1))])
        # the same text on both sides is the same cells, which cancel
        .where(~F.col("_new").eqNullSafe(F.col("_old")))
    )
    marker = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value")))

    def signed(side: str, sign: int) -> F.Column:
        cells = F.transform(F.concat(marker, payload_cells(F.col(side + ".payload_json"))), lambda c: F.struct(c["field"].alias("field"), c["value"].alias("value"), F.lit(sign).alias("sign")))
        return F.when(F.col(side).isNotNull(), cells).otherwise(F.array().cast("array<struct<field:string,value:string,sign:int>>"))

    cells = sides.select("_step", "product_id", F.explode(F.concat(signed("_new", 1), signed("_old", -1))).alias("_c"))
    left = (
        cells.groupBy("_step", "product_id", F.col("_c.field").alias("field"), F.col("_c.value").alias("value"))
        .agg(F.sum("_c.sign").alias("_n"))
        .where("_n <> 0")
    )
    presence = F.sum(F.when(F.col("field").isNull(), F.col("_n")))
    return (
        left.groupBy("_step", "product_id")
        .agg(
            F.when(presence > 0, "added").when(presence < 0, "removed").otherwise("changed").alias("change_kind"),
            F.array_sort(F.collect_set("field")).alias("changed_fields"),
        )
        .withColumnRenamed("_step", "generation")
    )
