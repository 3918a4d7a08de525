"""The registered queries: every operator, over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.functions import dates, numbers, text
from tillweave.operators.attach import JoinBounds, attach
from tillweave.operators.materialize import owned_scratch, scratch_path, stage
from tillweave.operators.surrogate import assign_ids
from tillweave.plans import costs, dimensions, facts, identity, products, quality, staging, warehouse
from tillweave.queries import report as source
from tillweave.queries.checksums import CHECKSUMS
from tillweave.queries.report import table
from tillweave.sources import sinks, workbooks
from tillweave.sources.reference import Exclusion, FixedSaleType, SaleTypes, load_spots
from tillweave.vocabulary import GROSS, LINEAGE, RECEIPT_COST, RECEIVED, UNIT_COST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- sources and sinks ---------------------------------------------------------------------------------------


@_query
def file_and_sheet_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-2, SRC-5..7 on every file and sheet of the reports."""
    sheets = source.cells(spark, sf).select("source_file", "source_sheet").distinct()
    kept = workbooks.with_lineage(sheets.where(workbooks.is_eligible(F.col("source_sheet"))), source.LOADED)
    return kept.select("source_file", "source_sheet_clean", "report_date_raw", "spot_id_raw")


@_query
def cells_to_columns(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4: cell maps with varying keys to one column per key."""
    wide = workbooks.project_cells(source.cells(spark, sf))
    wide = staging.normalize_metrics(wide)
    sale_columns = [name for name in wide.columns if name in ("Sprzedaż", "Paczki 1", "Paczki 2") or "%" in name]
    return wide.groupBy(F.col("Kod roboczy").alias("code")).agg(
        F.count("*").alias("n_rows"),
        F.lit(len(sale_columns)).alias("n_sale_columns"),
        *(
            F.sum(text.quoted(name)).alias("qty_" + name.replace("%", "_pct").replace(" ", "_").replace("ż", "z"))
            for name in sale_columns
        ),
    )


@_query
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4: tables with different columns, aligned by name."""
    events = table(spark, sf, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "value")
    others = events.where("coalesce(event_type, '') <> 'click'").select("user_id", "event_id", "event_type")
    return workbooks.union_tables([clicks, others])


@_query
def raw_layer(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1: the raw layer written by date, read back, and counted per date."""
    raw = staging.normalize_columns(source.report(spark, sf))
    path = scratch_path(spark, "raw")
    sinks.write_raw(raw, path)
    kept = sinks.read_raw(raw, path)
    return kept.groupBy("report_date_raw").agg(
        F.count("*").alias("n_rows"),
        F.count("Kod wewnętrzny").alias("n_recipes"),
        numbers.exact_sum(F.col("Suma")).cast("double").alias("suma"),
    )


@_query
def csv_table(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2: a model table written as CSV, read back under its schema."""
    dim = dimensions.build_dim_spot(source.spots(spark, sf))
    path = scratch_path(spark, "csv")
    sinks.write_table(dim, path, "csv")
    return spark.read.schema(dim.schema).csv(path, header=True)


@_query
def published_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2: two versions of two tables, each version published at once; the newest is read."""
    folder = scratch_path(spark, "published")
    spots = dimensions.build_dim_spot(source.spots(spark, sf))
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    sinks.publish({"spots": spots, "parts": parts.where("p_size <= 25")}, folder)
    sinks.publish({"spots": spots.where("spot_id % 2 = 0"), "parts": parts}, folder)
    held = sinks.read_published(spark, folder)
    counts = [
        held["spots"].agg(F.lit("spots").alias("name"), F.count("*").alias("n_rows"), F.sum("spot_id").cast("double").alias("total")),
        held["parts"].agg(F.lit("parts"), F.count("*"), numbers.exact_sum(F.col("p_retailprice")).cast("double")),
    ]
    return counts[0].union(counts[1])


# --- scalar functions ----------------------------------------------------------------------------------------


@_query
def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    """STR-1, STR-10, STR-12 on whole texts."""
    documents = table(spark, sf, "documents")
    body = F.col("text")
    return documents.select(
        "doc_id",
        text.clean_basic(body).alias("basic"),
        F.length(text.tidy(body)).alias("n_tidy"),
        text.identity_name(body).alias("identity_name"),
        text.identity_name(F.concat(F.lit("  "), "source", F.lit("\t "), "lang", F.lit("\n"))).alias("origin"),
    )


@_query
def normalized_name(spark: SparkSession, sf: str) -> DataFrame:
    """STR-11 on whole texts."""
    documents = table(spark, sf, "documents")
    return documents.select("doc_id", text.normalized_name(F.col("text")).alias("normalized"))


@_query
def split_names(spark: SparkSession, sf: str) -> DataFrame:
    """STR-13 on the lines of whole texts."""
    joined = F.translate("text", "\n", "|")
    names = text.split_names(joined)
    return table(spark, sf, "documents").select(
        "doc_id", F.size(names).alias("n_names"), text.join_names(F.array_sort(F.array_distinct(names))).alias("names")
    )


@_query
def product_group(spark: SparkSession, sf: str) -> DataFrame:
    """STR-2, STR-3, STR-7 on codes of many shapes."""
    code = F.concat(
        F.when(F.col("event_type") == "click", "c_")
        .when(F.col("event_type") == "view", " C-cat")
        .otherwise(" "),
        "user_id",
        F.lit("-X-"),
        "event_type",
        F.lit("-"),
        "user_id",
        F.lit("-"),
        "event_type",
        F.lit("  bar "),
        "event_id",
    )
    return (
        table(spark, sf, "events")
        .select("event_id", code.alias("code"))
        .select(
            "event_id",
            text.is_heated(F.col("code")).alias("is_heated"),
            text.clean_code(F.col("code")).alias("code_clean"),
            text.group_of_code(text.clean_code(F.col("code"))).alias("product_group"),
        )
    )


@_query
def numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    """NUM-1 on numbers in every accepted and refused spelling."""
    value = F.col("value").cast("string")
    spelled = (
        F.when(F.col("event_type") == "click", F.translate(value, ".", ","))
        .when(F.col("event_type") == "view", F.concat(F.lit("  "), value, F.lit("\t")))
        .when(F.col("event_type") == "error", F.concat(value, F.lit("d")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("+"), value, F.lit("e1")))
        .otherwise(value)
    )
    return table(spark, sf, "events").select(
        "event_id", numbers.text_to_number(spelled).alias("number"), F.lit("NaN").alias("nan_text")
    ).withColumn("nan_number", numbers.text_to_number(F.col("nan_text"))).drop("nan_text")


@_query
def date_parse(spark: SparkSession, sf: str) -> DataFrame:
    """DT-1 on every order date, with dates that do not exist and a century before."""
    priority = F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "dd.MM.yy")
    raw = (
        F.when(priority.startswith("1"), F.concat(F.lit("31.02."), F.date_format("o_orderdate", "yy")))
        .when(priority.startswith("2"), F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(priority.startswith("3"), F.concat(F.date_format("o_orderdate", "d.M."), F.lit("69")))
        .when(priority.startswith("4"), F.concat(F.date_format("o_orderdate", "d.M."), F.lit("68")))
        .otherwise(day)
    )
    parsed = staging.parse_dates(table(spark, sf, "orders").select("o_orderkey", raw.alias("report_date_raw")))
    return parsed.select("o_orderkey", "report_date")


@_query
def product_cells(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-1, PRJ-5, STR-1..7 on every report row."""
    return source.rows(spark, sf).select(
        "source_file",
        F.col("_sheet_ord").alias("sheet"),
        F.col("_row_ord").alias("row_ord"),
        "is_heated",
        "product_code_clean",
        "product_name_clean",
        "recipe_number_clean",
        "has_recipe_number",
        "product_identity_basis",
        "product_work_key",
        "product_group_fallback",
    )


# --- staging -------------------------------------------------------------------------------------------------


@_query
def sales_control(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-2, PRJ-3, NUM-1..6 on every report row."""
    return source.rows(spark, sf).select(
        F.col("_sheet_ord").alias("sheet"),
        F.col("_row_ord").alias("row_ord"),
        "report_date",
        F.col("Paczki").alias("paczki"),
        "sales_total_computed",
        "sales_total_difference",
        "sales_total_matches_control",
        "sales_validation_excluded",
    )


@_query
def spot_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """JN-1 with some spots unknown."""
    known = source.spots(spark, sf).where("city <> 'NATION_3'")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("spot_id_raw")
    )
    return staging.map_spots(lines, known)


@_query
def missing_spots(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-4: spot ids of the reports that the spot table lacks."""
    known = dimensions.build_dim_spot(source.spots(spark, sf).where("city <> 'NATION_3'"))
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("int").alias("spot_id_raw"))
    return quality.unmatched_keys(lines, known, "spot_id_raw")


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    return staging.product_observations(source.rows(spark, sf))


@_query
def name_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1, AGG-2."""
    names = staging.name_rollup(_observed(spark, sf))
    return names.select(
        "product_work_key",
        "product_name_selected",
        text.join_names(F.col("alternative_names")).alias("product_alternative_names"),
        F.size("alternative_names").alias("product_alternative_names_count"),
    )


@_query
def name_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """CASE-1, JN-9."""
    names = staging.product_names(_observed(spark, sf), source.corrections(spark))
    return names.select(
        "product_work_key",
        "product_name_canonical",
        "product_canonical_group",
        "product_name_corrected",
        "product_correction_action",
    )


@_query
def staging_products(spark: SparkSession, sf: str) -> DataFrame:
    """JN-10, STR-8, STR-9: names and flags on every report row."""
    raw = source.report(spark, sf)
    rows = staging.prepare_rows(raw, None, source.SALE_TYPES, products=False)
    observations = staging.staged_observations(source.rows(spark, sf))
    names = stage(staging.product_names(observations, source.corrections(spark)), "names")
    counts = observations.select("product_work_key", "n_rows")
    kept = staging.clean_products(rows, source.corrections(spark), names=names, counts=counts).select(
        F.col("_sheet_ord").alias("sheet"),
        F.col("_row_ord").alias("row_ord"),
        "report_date",
        "product_work_key",
        "product_name_selected",
        "product_alternative_names_count",
        "product_group_final",
        "is_system_product",
        "is_product_name_missing",
        "is_product_code_missing",
        "is_short_product_name_warning",
    )
    return stage(kept, "staging")


@_query
def staging_table(spark: SparkSession, sf: str) -> DataFrame:
    """The whole staging chain at once, summed per day and spot."""
    stg = staging.build_staging(
        source.report(spark, sf), source.spots(spark, sf), source.SALE_TYPES, source.corrections(spark)
    )
    summed = ["is_short_product_name_warning", "product_alternative_names_count", "product_name_selected", "sales_total_computed"]
    # Written, so that the joins' shuffle files are gone before the rows are shuffled by day and spot.
    stg = stage(stg.select("report_date", "spot_name", "city", *summed), "staging")
    sums = stg.groupBy("report_date", "spot_name", "city").agg(
        F.count("*").alias("n_rows"),
        F.count_if("is_short_product_name_warning").alias("n_short"),
        F.sum("product_alternative_names_count").alias("n_names"),
        F.max("product_name_selected").alias("last_name"),
        numbers.exact_sum(F.col("sales_total_computed")).cast("double").alias("total"),
    )
    return stage(sums, "staging-sums")


@_query
def staging_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """JN-10 by shuffle where a third of the rows has one work key: neither date, code nor recipe."""
    raw = source.report(spark, sf)
    known = F.col("Zwrócono").isNull()
    blanked = {name: F.when(known, F.col(name)) for name in ("Kod roboczy", "Kod wewnętrzny", "report_date_raw")}
    stg = staging.build_staging(
        raw.withColumns(blanked),
        source.spots(spark, sf),
        source.SALE_TYPES,
        source.corrections(spark),
        bounds=JoinBounds(broadcast_rows=0, salt_bytes=0),
    )
    return stg.groupBy((F.col("product_work_key") == "NO_DATE_NO_CODE").alias("is_hot")).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("product_work_key").alias("n_keys"),
        F.sum("product_alternative_names_count").alias("n_names"),
        F.max("product_name_selected").alias("last_name"),
    )


# --- dimensions ----------------------------------------------------------------------------------------------


@_query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-14, GEN-1, DT-3..5 over the order dates."""
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("report_date"))
    return dimensions.build_dim_date(orders, source.CALENDAR)


@_query
def dim_spot(spark: SparkSession, sf: str) -> DataFrame:
    """CAST-2, STR-10, WIN-2."""
    return dimensions.build_dim_spot(source.spots(spark, sf))


@_query
def dim_sale_type(spark: SparkSession, sf: str) -> DataFrame:
    """SET-1, STR-14, SRT-2: fixed types, and a type for each discount that the cells show."""
    wide = workbooks.project_cells(source.cells(spark, sf))
    return dimensions.build_dim_sale_type(wide, source.SALE_TYPES)


def _movement_table(spark: SparkSession, sf: str) -> DataFrame:
    """Movement types found in the line items: flags are movements, open lines are their details."""
    kinds = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    detail = F.col("l_linestatus") == "O"
    column = F.concat(F.lit(" move "), "l_returnflag", F.when(detail, " - detail ").otherwise(""))
    return kinds.select(
        column.alias("movement_type_column"),
        F.concat_ws("  ", "l_linestatus", "l_returnflag").alias("movement_type_name"),
        F.when(F.col("l_returnflag") == "N", "IN ").otherwise("OUT").alias("movement_direction"),
        detail.alias("is_additional_detail"),
        F.when(detail, F.concat(F.lit("move "), "l_returnflag")).otherwise(" ").alias("parent_movement_type_column"),
    )


@_query
def dim_movement_type(spark: SparkSession, sf: str) -> DataFrame:
    """STR-10, SRT-1, WIN-2."""
    return dimensions.build_dim_movement_type(_movement_table(spark, sf))


@_query
def movement_type_checks(spark: SparkSession, sf: str) -> DataFrame:
    """SET-2, SET-3, DQ-2 on movement types that are wrong."""
    kinds = _movement_table(spark, sf)
    wrong = kinds.withColumn(
        "parent_movement_type_column",
        F.when(F.col("is_additional_detail"), F.concat(F.col("parent_movement_type_column"), F.lit("?"))),
    ).withColumn("movement_direction", F.concat(F.lit("to "), text.tidy(F.col("movement_direction"))))
    dim = dimensions.build_dim_movement_type(wrong)
    return quality.movement_type_issues(dim).select("check_name", "severity", "table_name", "key", "n")


@_query
def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-2 by ranges, as for a dimension that is too large for one task."""
    parts = table(spark, sf, "part").select("p_name", "p_partkey")
    order = [F.col("p_name"), F.col("p_partkey").desc()]
    return assign_ids(parts, "part_id", order, one_task_rows=0, ranges=8)


# --- identity and products -----------------------------------------------------------------------------------


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    observations = staging.staged_observations(source.rows(spark, sf))
    names = stage(staging.product_names(observations, source.corrections(spark)), "names")
    return stage(identity.candidates_from_observations(observations, names), "candidates")


@_query
def product_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-3, SRT-4."""
    found = _candidates(spark, sf)
    return found.withColumn("alternative_names", F.array_join("alternative_names", "|"))


@_query
def product_identity(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-3."""
    return identity.resolve_identity(_candidates(spark, sf))


@_query
def product_identity_from_staging(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-3 from staging rows as they are, on codes without sizes, which makes longer chains of names."""
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    rows = lines.select(
        F.to_date("l_shipdate").alias("report_date"),
        F.col("p_type").alias("Kod roboczy"),
        F.col("p_name").alias("Nazwa"),
        F.when(F.col("p_size") <= 5, F.col("p_partkey")).alias("Kod wewnętrzny"),
    )
    stg = staging.clean_products(rows, source.corrections(spark))
    return identity.build_product_identity(stg)


@_query
def dq_group_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-9: names that occur in several groups."""
    return identity.group_conflicts(_candidates(spark, sf))


@_query
def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-4..9, RULE-1, RULE-2, WIN-2."""
    return source.model(spark, sf).dim_product


@_query
def product_types(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-7 with the number of groups that products show (DQ-9)."""
    model = source.model(spark, sf)
    keyed = model.keyed_variants()
    return products.most_frequent_group(keyed)


# --- facts ---------------------------------------------------------------------------------------------------


MOVED = [name for name, *_ in source.MOVEMENT_TYPES]
COSTS = [RECEIVED, UNIT_COST]


def _sold(rows: DataFrame, types: SaleTypes = source.SALE_TYPES) -> list[str]:
    sold = [item.source_column for item in types.fixed] + [rule.target_column for rule in types.grouped]
    return [*sold, *staging.percent_columns(rows.columns)]


def _shared(
    spark: SparkSession, sf: str, measures: list[str], types: SaleTypes = source.SALE_TYPES, sold: bool = False
) -> tuple[DataFrame, warehouse.ProductModel]:
    """The product model, and the rows as ``_rows`` makes them."""
    rows = _rows(spark, sf, measures, types, sold)
    return rows, warehouse.build_product_model(rows, source.corrections(spark), source.RULES)


def _rows(
    spark: SparkSession, sf: str, measures: list[str], types: SaleTypes = source.SALE_TYPES, sold: bool = False
) -> DataFrame:
    """The rows with the named measures, and those of sales if ``sold``; others are not computed."""
    rows = staging.prepare_rows(source.report(spark, sf), None, types)
    named = [name for name in dict.fromkeys([*(_sold(rows, types) if sold else []), *measures]) if name in rows.columns]
    return stage(warehouse.model_columns(rows, named), "rows")


@_query
def fact_sales_quantity(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-4, RSH-1, FLT-1, JN-3..6, AGG-10."""
    rows, model = _shared(spark, sf, [], sold=True)
    return facts.build_fact_sales_quantity(
        rows,
        model.identity,
        model.dim_product,
        dimensions.build_dim_sale_type(rows, source.SALE_TYPES),
        dimensions.build_dim_spot(source.spots(spark, sf)),
        keys=model.keys,
        counts=model.counts,
    )


@_query
def fact_sales_shared_column(spark: SparkSession, sf: str) -> DataFrame:
    """JN-6: two sale types of one column; its quantities count once, for the lower id."""
    grouped = SaleTypes(
        (*source.SALE_TYPES.fixed[:2], FixedSaleType("Paczki 2", "TWIN", "Paczki 2")),
        source.SALE_TYPES.grouped,
        source.SALE_TYPES.control_columns,
    )
    rows, model = _shared(spark, sf, [], grouped, sold=True)
    fact = facts.build_fact_sales_quantity(
        rows,
        model.identity,
        model.dim_product,
        dimensions.build_dim_sale_type(rows, grouped),
        dimensions.build_dim_spot(source.spots(spark, sf)),
        keys=model.keys,
        counts=model.counts,
    )
    return fact.groupBy("sale_type_id").agg(F.count("*").alias("n_rows"), F.sum("quantity").alias("quantity"))


@_query
def dq_product_types(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-9, LIM-1: products that show several groups."""
    model = source.model(spark, sf)
    keyed = model.keyed_variants()
    return quality.product_type_issues(products.most_frequent_group(keyed)).drop("detail")


@_query
def dq_daily_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-1, DQ-7 on the daily cost: costs below 950 are made null, the others turned round."""
    rows, model = _shared(spark, sf, COSTS)
    daily = _daily(spark, rows, model)
    changed = daily.withColumn("productcost", F.when(F.col("productcost") >= 950, -F.col("productcost")))
    names = ["date", "product_id", "productcost"]
    return quality.table_issues(changed, "productcost_daily_lookup", names, ["productcost"]).drop("detail")


@_query
def reference_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-8: spots written as files of one JSON object a line, and loaded again by all tasks under their schema."""
    folder = scratch_path(spark, "json")
    source.spots(spark, sf).repartition(4).write.json(folder)
    return dimensions.build_dim_spot(load_spots(spark, folder, lines=True))


@_query
def listed_files(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1: files of report rows, of which only those directly in a folder and of one extension are read."""
    folder = scratch_path(spark, "files")
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws(";", F.date_format("l_shipdate", "dd.MM.yy"), "l_suppkey", "l_quantity").alias("value"), "l_linenumber"
    )
    lines.where("l_linenumber > 1").select("value").repartition(8).write.text(folder)
    lines.where("l_linenumber = 1").select("value").write.text(f"{folder}/below")
    lines.where("l_linenumber = 1").select("value").write.option("compression", "gzip").mode("append").text(folder)
    listed = workbooks.list_files(spark, folder, "TXT")
    rows = listed.select(F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("line <> ''")
    cells = F.split("line", ";")
    return rows.groupBy(dates.report_date(cells[0]).alias("report_date")).agg(
        F.count("*").alias("n_rows"), F.countDistinct(cells[1]).alias("n_spots"), F.sum(cells[2].cast("double")).alias("quantity")
    )


@_query
def fact_sales_gross(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-2, JN-3..5, AGG-11."""
    rows, model = _shared(spark, sf, [GROSS])
    spots = dimensions.build_dim_spot(source.spots(spark, sf))
    return facts.build_fact_sales_gross(rows, model.identity, model.dim_product, spots, keys=model.keys, counts=model.counts)


@_query
def fact_productcost(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-3, JN-3, JN-4, AGG-13."""
    rows, model = _shared(spark, sf, COSTS)
    return facts.build_fact_productcost(rows, model.identity, model.dim_product, keys=model.keys, counts=model.counts)


@_query
def productcost_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-13, DQ-10."""
    rows, model = _shared(spark, sf, COSTS)
    return facts.productcost_conflicts(rows, model.identity, model.dim_product, keys=model.keys, counts=model.counts)


def _cost(rows: DataFrame, model: warehouse.ProductModel) -> DataFrame:
    fact = facts.build_fact_productcost(rows, model.identity, model.dim_product, keys=model.keys, counts=model.counts)
    return stage(fact, "productcost")


def _daily(spark: SparkSession, rows: DataFrame, model: warehouse.ProductModel) -> DataFrame:
    cost = _cost(rows, model)
    days = dimensions.build_dim_date(model.observations, source.CALENDAR)
    return costs.build_productcost_daily_lookup(cost, stage(days, "days"))


@_query
def productcost_daily_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """GEN-2, WIN-1, JN-11."""
    return _daily(spark, *_shared(spark, sf, COSTS))


@_query
def daily_lookup_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """SRT-3: the daily cost written in the order of product and day, and read back with each row's number there."""
    daily = _daily(spark, *_shared(spark, sf, COSTS))
    return sinks.write_in_order(daily, scratch_path(spark, "in-order"), ["product_id", "date"])


@_query
def daily_lookup_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """GEN-2, WIN-1: the daily cost made by month, written by month, and summed from the written months."""
    rows, model = _shared(spark, sf, COSTS)
    cost = _cost(rows, model)
    days = stage(dimensions.build_dim_date(model.observations, source.CALENDAR), "days")
    daily = costs.daily_by_month(cost, days)
    written = sinks.write_by_month(daily, scratch_path(spark, "by-month"), "date", ["product_id", "date"])
    return written.groupBy("month").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("product_id").alias("n_products"),
        F.min("date").alias("first_day"),
        numbers.exact_sum(F.col("productcost")).cast("double").alias("productcost"),
    )


@_query
def fact_inventory_movement(spark: SparkSession, sf: str) -> DataFrame:
    """RSH-2, FLT-1, JN-3..5, JN-7, JN-8, CASE-2, AGG-12, valued as of the cost events."""
    rows, model = _shared(spark, sf, [*MOVED, UNIT_COST, RECEIPT_COST])
    cost = _cost(rows, model)
    return facts.build_fact_inventory_movement(
        rows,
        model.identity,
        model.dim_product,
        dimensions.build_dim_spot(source.spots(spark, sf)),
        dimensions.build_dim_movement_type(source.movement_types(spark)),
        cost,
        as_of=True,
        keys=model.keys,
        counts=model.counts,
    )


@_query
def fact_inventory_movement_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """The same, valued by the daily cost table."""
    rows = _rows(spark, sf, [*MOVED, UNIT_COST, RECEIPT_COST])
    paths = [scratch_path(spark, name) for name in ("product-keys", "counts", "days")]
    with owned_scratch(spark):  # what the model is made of goes before rows are shuffled for the fact
        model = warehouse.build_product_model(rows, source.corrections(spark), source.RULES)
        days = dimensions.build_dim_date(model.observations, source.CALENDAR)
        made = zip((model.keys, model.counts, days), paths, strict=True)
        keys, counts, days = [stage(df, "kept", path) for df, path in made]
    cost = stage(facts.build_fact_productcost(rows, None, None, keys=keys, counts=counts), "productcost")
    return facts.build_fact_inventory_movement(
        rows,
        None,
        None,
        dimensions.build_dim_spot(source.spots(spark, sf)),
        dimensions.build_dim_movement_type(source.movement_types(spark)),
        costs.build_productcost_daily_lookup(cost, days),
        keys=keys,
        counts=counts,
    )


@_query
def movement_cost_issues(spark: SparkSession, sf: str) -> DataFrame:
    """CASE-2, DQ-10: movement rows by the cost they lacked."""
    rows, model = _shared(spark, sf, [*MOVED, UNIT_COST, RECEIPT_COST])
    base = stage(
        facts.movement_base(
            rows,
            model.identity,
            model.dim_product,
            dimensions.build_dim_spot(source.spots(spark, sf)),
            dimensions.build_dim_movement_type(source.movement_types(spark)),
            keys=model.keys,
            counts=model.counts,
        ),
        "movements",
    )
    cost = facts.build_fact_productcost(rows, model.identity, model.dim_product, keys=model.keys, counts=model.counts)
    return facts.movement_cost_issues(facts.value_movements(base, costs.unit_costs_as_of(base, cost)))


# --- joins at scale ------------------------------------------------------------------------------------------


@_query
def attach_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """JN-3..7 beyond the broadcast bound: a third of the lines has one key, which is salted."""
    key = F.when(F.col("l_returnflag") == "R", F.lit(7)).otherwise(F.col("l_suppkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", key.alias("s_suppkey"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name").where("s_nationkey <> 3")
    return attach(lines, suppliers, "s_suppkey", bounds=JoinBounds(broadcast_rows=0, salt_bytes=0))


# --- data quality --------------------------------------------------------------------------------------------


@_query
def dq_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-1 on the staging rows."""
    rows = source.rows(spark, sf)
    columns = ["report_date", "product_code_clean", "recipe_number_clean", "Sprzedaż", "Suma", "koszt-jednostka"]
    return quality.null_counts(rows, columns, "staging")


@_query
def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-2: lines that share date and part."""
    lines = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date"), "l_partkey")
    return quality.duplicate_keys(lines, ["date", "l_partkey"])


@_query
def dq_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-4, LIM-1: number and first 20 of the documents without a label."""
    labels = table(spark, sf, "labels").select("doc_id").distinct()
    return quality.unmatched_issues(table(spark, sf, "documents"), labels, "doc_id", "documents")


@_query
def dq_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-5, AGG-15: texts that are no number."""
    raw = table(spark, sf, "events").select("props", numbers.text_to_number(F.col("props")).alias("number"))
    return quality.invalid_values(raw, "props", "number")


@_query
def dq_conservation(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-6: totals of the line items before and after a sum by part."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    by_part = lines.groupBy("l_partkey").agg(
        numbers.exact_sum(F.col("l_quantity")).cast("double").alias("quantity"),
        numbers.exact_sum(F.col("l_extendedprice")).cast("double").alias("amount"),
    )
    totals = quality.conservation(lines, by_part, {"l_quantity": "quantity", "l_extendedprice": "amount"})
    return totals.select(
        "measure", F.col("before").cast("double").alias("before"), F.col("after").cast("double").alias("after")
    )


@_query
def dq_negative(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-7."""
    return quality.negative_counts(table(spark, sf, "supplier"), ["s_acctbal", "s_suppkey"], "supplier")


@_query
def dq_short_names(spark: SparkSession, sf: str) -> DataFrame:
    """STR-9, DQ-10, AGG-15 on all line items: names cut to a few characters, and products of the technical group."""
    raw = source.report(spark, sf)
    short = F.when(F.col("Suma").isNull(), F.expr("substr(`Kod roboczy`, 1, 3 + _sheet_ord % 6)"))
    code = F.when(F.col("_sheet_ord") % 4 == 0, F.lit(text.SYSTEM_GROUP)).otherwise(F.col("Kod roboczy"))
    raw = raw.withColumn(" Nazwa  ", F.coalesce(short, F.col("Kod roboczy"), F.lit("unnamed"))).withColumn("Kod roboczy", code)
    stg = staging.build_staging(raw, source.spots(spark, sf), source.SALE_TYPES, source.corrections(spark))
    return quality.short_names(stg)


@_query
def raw_checks(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-1, DQ-3, DQ-8 on the raw rows: with dates missing, without a column, and without rows."""
    raw = source.report(spark, sf)
    undated = raw.withColumn("report_date_raw", F.when(F.col("Suma").isNotNull(), F.col("report_date_raw")))
    without = raw.drop("source_sheet", "load_timestamp")
    return quality.unite(
        warehouse.validate_raw(undated),
        quality.missing_columns(without, LINEAGE, "raw"),
        warehouse.validate_raw(raw.where("spot_id_raw < 0")),
    ).select("check_name", "severity", "table_name", "key", "n")


@_query
def watched_facts(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-1, DQ-6, DQ-7, DQ-8 observed while two facts are written: totals before and after, rows, nulls, negatives."""
    rows, model = _shared(spark, sf, [GROSS], sold=True)
    spots = dimensions.build_dim_spot(source.spots(spark, sf).where("city <> 'NATION_3'"))
    types = dimensions.build_dim_sale_type(rows, source.SALE_TYPES)
    sold = quality.Watch("fact_sales_quantity", {"quantity": "quantity"}, ["spot_id"], ["quantity"])
    earned = quality.Watch("fact_sales_gross", {"amount": "amount"}, ["spot_id"], ["amount"])
    quantity = facts.build_fact_sales_quantity(
        rows, model.identity, model.dim_product, types, spots, keys=model.keys, counts=model.counts, seen=sold.before
    )
    gross = facts.build_fact_sales_gross(
        rows, model.identity, model.dim_product, spots, keys=model.keys, counts=model.counts, seen=earned.before
    )
    found = []
    for watch, fact in ((sold, quantity), (earned, gross)):
        before, after = watch.totals(stage(watch.after(fact), "fact"))
        totals = (float(before["total_0"]), float(after["total_0"]))
        found.append((watch.table, *totals, after["n_rows"], after["nulls_0"], after["negatives_0"]))
    return spark.createDataFrame(
        found, "table_name string, before double, after double, n_rows long, n_nulls long, n_negatives long"
    )


@_query
def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3: of two intermediate tables the one that is asked for is kept."""
    folder = scratch_path(spark, "snapshots")
    observed = _observed(spark, sf)
    asked = frozenset({"observations"})
    sinks.snapshot(observed, "observations", folder, asked)
    sinks.snapshot(observed.select("product_work_key"), "product_keys", folder, asked)
    kept = spark.read.parquet(f"{folder}/*").groupBy(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("name"))
    return kept.agg(F.sum("n_rows").alias("n_rows"), F.countDistinct("product_work_key").alias("n_keys"))


@_query
def dq_control_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """NUM-5, NUM-6, DQ-10: rows whose control total differs, excluded codes aside."""
    excluded = SaleTypes(
        source.SALE_TYPES.fixed,
        source.SALE_TYPES.grouped,
        source.SALE_TYPES.control_columns,
        (Exclusion("Kod roboczy", ("CAT01-X-3-4", "LARGE-7")), Exclusion("absent", ("x",))),
    )
    rows = staging.prepare_rows(source.report(spark, sf), None, excluded)
    return quality.control_mismatch_issues(rows).drop("detail")


# --- the full run --------------------------------------------------------------------------------------------


@_query
def warehouse_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The full run with all checks: rows and a checksum of each table it wrote."""
    settings = source.settings(spark, sf)
    folder = scratch_path(spark, "warehouse")
    out = warehouse.run_warehouse(
        source.report(spark, sf), settings, folder, snapshot_folder=f"{folder}/snapshots"
    )
    sums = [
        out[name].agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.expr(f"CAST(sum({checksum}) AS BIGINT)").alias("checksum"),
        )
        for name, checksum in CHECKSUMS.items()
    ]
    return quality.unite(*sums)
