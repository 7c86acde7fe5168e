"""Arrays, specs and variants, over documents and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.text import item_name, item_sku, prefix_key
from quayside.operators.nested import (
    collect_ordered_distinct,
    collect_sorted_sets,
    explode_children,
    explode_path,
    first_of,
    pluck,
    select_with,
)
from quayside.operators.variants import (
    contains_match,
    deal_products,
    expand_variants,
    label_values,
    option_lists,
    option_members,
)
from quayside.workload import query
from quayside.workload.inputs import load


def products(spark, sf, *extra: str):
    """Parts as product documents: a Type and a Size spec, no specs for one brand, an empty list for large sizes."""
    option = "struct<ID:string,Value:string>"

    def options(*pairs):
        return F.array(*[F.struct(F.lit(k).alias("ID"), F.lit(v).alias("Value")) for k, v in pairs])

    kinds = F.array(
        F.struct(F.col("p_type").alias("ID"), F.lower("p_type").alias("Value")),
        F.struct(F.lit("STD").alias("ID"), F.lit("std").alias("Value")),
    )
    sizes = (
        F.when(F.col("p_size") > 40, F.array().cast(f"array<{option}>"))
        .when(F.col("p_size") > 10, options(("S", "small"), ("M", "medium"), ("L", "large")))
        .otherwise(options(("1", "one"), ("10", "ten")))
    )
    specs = F.array(
        F.struct(F.lit("Type").alias("ID"), F.lit("kind").alias("Name"), kinds.alias("Options")),
        F.struct(F.lit("Size").alias("ID"), F.lit("size").alias("Name"), sizes.alias("Options")),
    )
    return load(spark, sf, "part").select(
        prefix_key("p_partkey").alias("ExternalProductID"),
        F.col("p_name").alias("Name"),
        F.when(F.col("p_brand") != "Brand#7", specs).alias("Specs"),
        *extra,
    )


# The same documents in SQL: `opt` has one row per option, `lst` the sorted option lists.
PRODUCTS_SQL = """
prod AS (
  SELECT 'SC-' || p_partkey::VARCHAR AS id, p_name AS name, p_brand <> 'Brand#7' AS has_specs, p_type,
         CASE WHEN p_size > 40 THEN []::VARCHAR[] WHEN p_size > 10 THEN ['S', 'M', 'L'] ELSE ['1', '10'] END AS sizes
  FROM part),
opt AS (
  SELECT id, name, 'Type' AS spec, unnest([p_type, 'STD']) AS o, unnest([lower(p_type), 'std']) AS v FROM prod WHERE has_specs
  UNION ALL
  SELECT id, name, 'Size', o, CASE o WHEN 'S' THEN 'small' WHEN 'M' THEN 'medium' WHEN 'L' THEN 'large'
                                     WHEN '1' THEN 'one' ELSE 'ten' END
  FROM (SELECT id, name, unnest(sizes) AS o FROM prod WHERE has_specs)),
lst AS (SELECT id, name, list_sort([[p_type, 'STD'], sizes]) AS l FROM prod WHERE has_specs),
one AS (SELECT id, name, l, unnest(l[1]) AS a FROM lst),
var AS (SELECT id, name, a, b, id || '-' || a || '-' || b AS variant FROM (SELECT *, unnest(l[2]) AS b FROM one)),
chr AS (SELECT variant, var.id, var.name, spec, o, v FROM var JOIN opt ON opt.id = var.id AND opt.o IN (a, b))
"""


def variants(spark, sf):
    rows = deal_products(products(spark, sf), "ExternalProductID").withColumn("lists", option_lists("Specs"))
    rows = rows.withColumn("members", option_members("Specs", "lists"))
    return expand_variants(rows, "ExternalProductID", "lists", members="members")


@query(
    "explode_lines",
    """SELECT doc_id, CAST(i AS INTEGER) AS line_no, string_split(text, chr(10))[i] AS line FROM
    (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)""",
)
def explode_lines(spark, sf):
    lines = F.transform(
        F.split("text", "\n"), lambda line, i: F.struct((i + 1).alias("line_no"), line.alias("line"))
    )
    rows = load(spark, sf, "documents").select("doc_id", lines.alias("lines"))
    return explode_children(rows, "lines", "l").select("doc_id", "l.line_no", "l.line")


@query(
    "explode_outer_lines",
    """WITH w AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: contains(x, '@')) AS l FROM documents)
    SELECT doc_id, unnest(l) AS line FROM w WHERE len(l) > 0
    UNION ALL SELECT doc_id, NULL FROM w WHERE len(l) = 0""",
)
def explode_outer_lines(spark, sf):
    """Lines with an address sign; documents without any keep one row."""
    lines = F.filter(F.split("text", "\n"), lambda line: F.contains(line, F.lit("@")))
    rows = load(spark, sf, "documents").select("doc_id", lines.alias("lines"))
    return explode_children(rows, "lines", "line", outer=True)


@query("explode_path", f"WITH {PRODUCTS_SQL} SELECT id AS product, spec, o AS option_id, v AS option_value FROM opt")
def explode_options(spark, sf):
    rows = explode_path(products(spark, sf), ["Specs", "Options"], ["spec", "option"])
    return rows.select(
        F.col("ExternalProductID").alias("product"),
        F.col("spec.ID").alias("spec"),
        F.col("option.ID").alias("option_id"),
        F.col("option.Value").alias("option_value"),
    )


@query(
    "pluck_and_first",
    """SELECT 'SC-' || p_partkey::VARCHAR AS product, CASE WHEN p_brand <> 'Brand#7' THEN 'Type,Size' END AS spec_ids,
       CASE WHEN p_brand <> 'Brand#7' THEN 'SC-Type' END AS first_spec,
       CASE WHEN p_brand <> 'Brand#7' THEN 2 END AS specs FROM part""",
)
def pluck_and_first(spark, sf):
    return products(spark, sf).select(
        F.col("ExternalProductID").alias("product"),
        F.array_join(pluck("Specs", "ID"), ",").alias("spec_ids"),
        prefix_key(first_of("Specs", "ID")).alias("first_spec"),
        F.size("Specs").alias("specs"),
    )


@query(
    "first_category",
    """SELECT doc_id, 'SC-' || string_split(text, ' ')[1] AS first_word,
       list_filter(string_split(text, ' '), lambda x: contains(x, '@'))[1] AS first_address FROM documents""",
)
def first_category(spark, sf):
    words = F.split("text", " ")
    return load(spark, sf, "documents").select(
        "doc_id",
        prefix_key(first_of(words)).alias("first_word"),
        first_of(F.filter(words, lambda w: F.contains(w, F.lit("@")))).alias("first_address"),
    )


@query(
    "collect_sorted_sets",
    """SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_type || '+' || p_size::VARCHAR)), ';') AS lists
    FROM part GROUP BY p_brand""",
)
def sorted_sets(spark, sf):
    rows = load(spark, sf, "part").select(
        "p_brand", F.array("p_type", F.col("p_size").cast("string")).alias("pair")
    )
    joined = F.array_join(F.array_sort(F.transform("lists", lambda p: F.array_join(p, "+"))), ";")
    return collect_sorted_sets(rows, "p_brand", "pair", "lists").select("p_brand", joined.alias("lists"))


@query(
    "collect_ordered_distinct",
    """WITH f AS (SELECT p_brand, p_name, min(p_partkey) AS k FROM part GROUP BY p_brand, p_name)
    SELECT p_brand, string_agg(p_name, '.' ORDER BY k) AS names FROM f GROUP BY p_brand""",
)
def ordered_distinct(spark, sf):
    rows = collect_ordered_distinct(load(spark, sf, "part"), ["p_brand"], "p_name", "p_partkey", "names")
    return rows.select("p_brand", F.array_join("names", ".").alias("names"))


@query(
    "expand_variants",
    f"""WITH {PRODUCTS_SQL} SELECT id AS product, variant FROM var
    UNION ALL SELECT id, NULL FROM prod WHERE id NOT IN (SELECT id FROM var)""",
)
def expand(spark, sf):
    return variants(spark, sf).select(
        F.col("ExternalProductID").alias("product"), F.col("ProductID").alias("variant")
    )


@query("variant_characteristics", f"WITH {PRODUCTS_SQL} SELECT variant, spec, o AS option_id, v AS value FROM chr")
def characteristics(spark, sf):
    rows = variants(spark, sf)
    return rows.select(F.col("ProductID").alias("variant"), F.explode("characteristics").alias("c")).select(
        "variant", F.col("c.spec_id").alias("spec"), "c.option_id", "c.value"
    )


@query(
    "contains_match",
    f"""WITH {PRODUCTS_SQL} SELECT DISTINCT variant, spec, o AS option_id, v AS value
    FROM var JOIN opt ON opt.id = var.id AND contains(variant, o)""",
)
def by_text(spark, sf):
    rows = variants(spark, sf).withColumn("c", contains_match("Specs", "ProductID"))
    return rows.select(F.col("ProductID").alias("variant"), F.explode("c").alias("c")).select(
        "variant", F.col("c.spec_id").alias("spec"), "c.option_id", "c.value"
    )


@query(
    "item_names",
    f"""WITH {PRODUCTS_SQL}, lab AS (
      SELECT variant, name || '-' || string_agg(v, '.' ORDER BY o) AS n
      FROM (SELECT variant, name, v, min(o) AS o FROM chr GROUP BY variant, name, v) GROUP BY variant, name)
    SELECT variant AS product, variant || '-sku' AS sku, n AS item_name FROM lab
    UNION ALL SELECT id, CASE WHEN has_specs THEN id || '-sku' END, CASE WHEN NOT has_specs THEN name END
    FROM prod WHERE id NOT IN (SELECT id FROM var)""",
)
def names(spark, sf):
    rows = variants(spark, sf)
    own = F.coalesce("ProductID", "ExternalProductID")
    return rows.select(
        own.alias("product"),
        item_sku(own, "Specs").alias("sku"),
        item_name("Name", label_values("characteristics"), "Specs").alias("item_name"),
    )


@query(
    "select_with_generated",
    "SELECT r_regionkey, r_name, unnest([r_name, 'all']) AS label FROM region",
)
def generated(spark, sf):
    return select_with(load(spark, sf, "region"), F.explode(F.array("r_name", F.lit("all"))), "label")
