"""Conservative merges of nested records: safe pairs, groups, a canonical member, arrays merged by key, sums taken again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.operators.graph import components
from vitrine.sources.shared import write_table

PROBABLE, MOST_DECLARATIONS = 0.9, 20


def strict_subset(a: Column, b: Column) -> Column:
    """Whether one of two token arrays holds all of the other and more; never for an empty one."""
    less = lambda x, y: (F.size(F.array_except(x, y)) == 0) & (F.size(F.array_except(y, x)) > 0)
    return (F.size(a) > 0) & (F.size(b) > 0) & (less(a, b) | less(b, a))


def safe_pairs(pairs: DataFrame, records: DataFrame, least: float = PROBABLE) -> DataFrame:
    """Pairs (l, r, probability) of ``records`` (id, name_tokens, org_tokens) that may merge without review: probable, one name
    strictly within the other, and a telling word of an organisation in common. Pairs that bring these columns of both records
    as structs l_of and r_of are not joined with them."""
    side = lambda e: records.select(F.col("id").alias(e), F.struct("name_tokens", "org_tokens").alias(f"{e}_of"))
    both = pairs.where(F.col("probability") >= least)
    if not {"l_of", "r_of"} <= set(pairs.columns):
        both = both.join(side("l"), "l").join(side("r"), "r")
    return both.where(strict_subset(F.col("l_of.name_tokens"), F.col("r_of.name_tokens")) & F.arrays_overlap("l_of.org_tokens", "r_of.org_tokens")).select("l", "r")


def groups(pairs: DataFrame, records: DataFrame, better: list[Column]) -> DataFrame:
    """(id, canonical, turn): members of the groups that ``pairs`` tie together; turn 0 is the canonical one, with the most
    pairs, then by ``better``, then the smallest id; the others follow by id."""
    pairs = write_table(pairs.select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b")).distinct(), "merge-pairs")
    ends = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).groupBy("id").agg(F.count("*").alias("links"))
    placed = components(pairs, "merge-groups").withColumnRenamed("node", "id").join(ends, "id").join(records, "id")
    # a group is a component of pairs that are safe to merge: one person's records
    first = Window.partitionBy("component").orderBy(F.col("links").desc(), *better, "id")
    placed = placed.withColumn("canonical", F.first("id").over(first))
    turn = F.row_number().over(Window.partitionBy("component").orderBy((F.col("id") != F.col("canonical")), "id")) - 1
    return placed.select("id", "canonical", turn.alias("turn"))


def merged_array(members: DataFrame, records: DataFrame, array: str, key: list[Column], most: int | None = None) -> DataFrame:
    """(canonical, ``array``): the members' arrays one after the other, of items of equal ``key`` (expressions over x) the first only.

    Nothing is collected before items are told apart: the arrays are exploded, the first of each key is an aggregate,
    and the array is put together from those."""
    items = records.join(members, "id").select("canonical", "turn", F.posexplode(array).alias("place", "x"))
    names = [f"__k{i}" for i in range(len(key))]
    per = items.select("*", *[c.alias(n) for c, n in zip(key, names, strict=True)]).groupBy("canonical", *names)
    first = per.agg(F.min_by(F.struct("turn", "place", "x"), F.struct("turn", "place")).alias("i"))
    whole = F.transform(F.array_sort(F.collect_list("i"), lambda a, b: _by_place(a, b)), lambda i: i["x"])
    return first.groupBy("canonical").agg((F.slice(whole, 1, most) if most else whole).alias(array))


def _by_place(a: Column, b: Column) -> Column:
    later = (a["turn"] > b["turn"]) | ((a["turn"] == b["turn"]) & (a["place"] > b["place"]))
    return F.when(later, 1).when((a["turn"] == b["turn"]) & (a["place"] == b["place"]), 0).otherwise(-1)


def company_totals(companies: Column) -> Column:
    """struct(n_companies, n_with_contracts, contracts, direct) of an array of (cui, contracts, direct): contracts count once for each
    cui, the last one that has any; direct purchases count with every entry."""
    with_contracts = F.filter(companies, lambda c: c["contracts"].isNotNull())
    codes = F.array_distinct(F.transform(with_contracts, lambda c: c["cui"]))
    last = lambda code: F.element_at(F.filter(with_contracts, lambda c: c["cui"].eqNullSafe(code)), -1)["contracts"]
    add = lambda values: F.aggregate(values, F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + F.coalesce(x, F.lit(0))).cast("decimal(38,2)"))
    return F.struct(
        F.size(F.array_distinct(F.transform(companies, lambda c: c["cui"]))).alias("n_companies"),
        F.size(codes).alias("n_with_contracts"),
        add(F.transform(codes, last)).alias("contracts"),
        add(F.transform(companies, lambda c: c["direct"])).alias("direct"),
    )


def merge(records: DataFrame, pairs: DataFrame, better: list[Column]) -> DataFrame:
    """``records`` (id, name, name_tokens, org_tokens, declarations, companies) after the safe merges of ``pairs``: one
    row per person left, with merged_from, n_declarations (20 kept at most) and the totals of the merged companies.

    Declarations are equal by (kind, institution, income), companies by (cui, trimmed lower-case name, role). The name is that
    of the canonical member unless another member's name strictly holds all of it and is longer."""
    members = write_table(groups(safe_pairs(pairs, records), records, better), "merge-members")
    x = F.col("x")
    declarations = merged_array(members, records, "declarations", [x["kind"], x["institution"], x["income"]], MOST_DECLARATIONS)
    companies = merged_array(members, records, "companies", [x["cui"], F.lower(F.trim(x["name"])), x["role"]])
    name = members.join(records.select("id", "name", "name_tokens"), "id")
    canon = name.where("turn = 0").select("canonical", F.col("name_tokens").alias("own"))
    longer = name.join(canon, "canonical").where((F.size(F.array_except("own", "name_tokens")) == 0) & (F.size("name_tokens") > F.size("own")))
    longer = longer.groupBy("canonical").agg(F.max_by("name", F.struct(F.size("name_tokens"), -F.col("turn"))).alias("longer"))
    merged_from = members.where("turn > 0").groupBy("canonical").agg(F.array_sort(F.collect_list("id")).alias("merged_from"))
    new = merged_from.join(declarations, "canonical", "left").join(companies, "canonical", "left").join(longer, "canonical", "left")
    new = new.select(F.col("canonical").alias("id"), "merged_from", F.col("declarations").alias("d"), F.col("companies").alias("c"), "longer")
    gone = members.where("turn > 0").select("id")
    kept = records.join(gone, "id", "left_anti").join(new, "id", "left")
    kept = kept.select(
        "id",
        F.coalesce("longer", "name").alias("name"),
        F.coalesce("merged_from", F.array().cast(merged_from.schema["merged_from"].dataType)).alias("merged_from"),
        F.coalesce("d", "declarations").alias("declarations"),
        F.coalesce("c", "companies").alias("companies"),
    )
    return kept.select("*", F.size("declarations").alias("n_declarations"), company_totals(F.col("companies")).alias("t")).select("*", "t.*").drop("t")
