"""Reader and writer queries: a derived table goes through the file format and back.

Files go to the session's shared checkpoint folder, each run into a folder of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from billproof.session import ensure_checkpoint_dir
from billproof.sources import readers as R
from billproof.sources import tables as S

from . import query
from .fixtures import table


def scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/registered-{uuid.uuid4().hex}"


def customers(spark, sf):
    c = F.col
    return table(spark, sf, "customer").select(
        c("c_custkey").cast("string").alias("id"), F.concat(c("c_name"), F.lit(" é")).alias("nome"), c("c_acctbal").alias("saldo")
    )


CUSTOMER_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' é' AS nome, c_acctbal AS saldo FROM customer"


@query("s1_table_scan", "SELECT c_custkey, c_name FROM customer")
def s1(spark, sf):
    return R.table(spark, f"{sf}/customer.parquet").select("c_custkey", "c_name")


@query("s3_read_dump", CUSTOMER_SQL.replace("c_acctbal AS", "CAST(c_acctbal AS DOUBLE) AS"))
def s3(spark, sf):
    path = scratch(spark)
    customers(spark, sf).write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return R.read_dump(spark, path, "csv").withColumn("saldo", F.col("saldo").cast("double"))


@query("s4_read_sheet", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' é' AS nome FROM customer")
def s4(spark, sf):
    path = scratch(spark)
    S.to_csv(customers(spark, sf).select("id", "nome"), path, ";", bom=True)
    return R.read_sheet(spark, path)


@query("s5_read_pipe", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' é' AS nome FROM customer")
def s5(spark, sf):
    path = scratch(spark)
    customers(spark, sf).select("id", "nome").write.option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    return R.read_pipe(spark, path, ["id", "nome"])


@query("s6_read_csv", "SELECT CAST(c_custkey AS BIGINT) AS id, c_name || ' é' AS nome, c_acctbal AS saldo FROM customer")
def s6(spark, sf):
    path = scratch(spark)
    S.to_csv(customers(spark, sf), path, ",")
    return R.read_csv(spark, path).withColumn("id", F.col("id").cast("bigint"))


@query(
    "s7_coerce_types",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS n, CASE WHEN o_orderkey % 3 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN FALSE ELSE TRUE END END AS b FROM orders",
)
def s7(spark, sf):
    from pyspark.sql.types import BooleanType, LongType

    blank = F.col("o_orderkey") % 3 == 0
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(blank, "NaN").otherwise(F.col("o_custkey").cast("string")).alias("n"),
        F.when(blank, "None").when(F.col("o_orderkey") % 2 == 0, "False").otherwise("x").alias("b"),
    )
    return R.coerce(raw, {"o_orderkey": LongType(), "n": LongType(), "b": BooleanType()})


@query("s8_append_merge", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' é' AS nome, NULL AS saldo FROM customer UNION ALL " + CUSTOMER_SQL)
def s8(spark, sf):
    path = scratch(spark)
    S.append(customers(spark, sf).select("id", "nome"), path)
    S.append(customers(spark, sf), path)
    return S.read_merged(spark, path).select("id", "nome", "saldo")


@query("s9_overwrite", CUSTOMER_SQL)
def s9(spark, sf):
    path = scratch(spark)
    S.overwrite(customers(spark, sf).select("id"), path)
    S.overwrite(customers(spark, sf), path)
    return spark.read.parquet(path)


@query("s11_replace_all", CUSTOMER_SQL)
def s11(spark, sf):
    path = scratch(spark)
    S.replace_all(customers(spark, sf).select("id", F.lit("velho").alias("nome")), path)
    S.replace_all(customers(spark, sf), path)
    S.replace_all(spark.read.parquet(path), path)  # the table from its own rows
    return spark.read.parquet(path)


@query(
    "s10_replace_slice",
    """SELECT o_orderkey, o_orderstatus AS regra, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS versao FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'outra', 1 FROM orders""",
)
def s10(spark, sf):
    path = scratch(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("regra"), F.lit("2026-07").alias("lote"))
    first = orders.unionByName(orders.withColumn("regra", F.lit("outra"))).withColumn("versao", F.lit(1))
    S.replace_slice(first, path, "lote", "2026-07", "regra", ["F", "O", "P", "outra"])
    second = orders.where("regra = 'F'").withColumn("versao", F.lit(2))
    for _ in range(2):  # twice gives the same table
        S.replace_slice(second, path, "lote", "2026-07", "regra", ["F", "P"])
    return spark.read.parquet(path).select("o_orderkey", "regra", "versao")


@query("s12_upsert_snapshot", "SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'novo' ELSE c_name END AS nome FROM customer")
def s12_snapshot(spark, sf):
    root = scratch(spark)
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nome"))
    S.upsert_snapshot(base, root, ["k"])
    S.upsert_snapshot(base.where("k % 2 = 0").withColumn("nome", F.lit("novo")), root, ["k"])
    return S.read_snapshot(spark, root)


@query(
    "s20_write_metrics",
    "SELECT (SELECT COUNT(*) FROM supplier) AS inseridos, (SELECT COUNT(*) FROM customer WHERE c_custkey % 2 = 0) AS atualizados, (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM supplier) AS total",
)
def s20(spark, sf):
    root = scratch(spark)
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.md5("c_name").alias("hash"))
    S.upsert_snapshot(base, root, ["k"], "hash")
    changed = base.withColumn("hash", F.when(F.col("k") % 2 == 0, F.md5(F.lit("x"))).otherwise(F.col("hash")))
    new = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1000000).alias("k"), F.md5("s_name").alias("hash"))
    done = S.upsert_snapshot(changed.unionByName(new), root, ["k"], "hash")
    return S.read_snapshot(spark, root).agg(
        F.max(F.lit(done["insert"])).alias("inseridos"), F.max(F.lit(done["update"])).alias("atualizados"), F.count(F.lit(1)).alias("total")
    )


@query(
    "s13_merge_cycle",
    """SELECT o_orderkey AS k, strftime(o_orderdate, '%Y%m') AS ciclo, CASE WHEN strftime(o_orderdate, '%Y%m') = '199803' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'novo' ELSE 'velho' END ELSE 'velho' END AS valor FROM orders
UNION ALL SELECT -1, '199803', 'extra' FROM region WHERE r_regionkey = 0""",
)
def s13_merge(spark, sf):
    path = scratch(spark)
    c = F.col
    stored = table(spark, sf, "orders").select(c("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyyMM").alias("ciclo"), F.lit("velho").alias("valor"))
    S.overwrite(stored, path, ["ciclo"])
    change = stored.where("ciclo = '199803'").withColumn("valor", F.when(c("k") % 2 == 0, "novo").otherwise(c("valor")))
    extra = table(spark, sf, "region").where("r_regionkey = 0").select(F.lit(-1).cast("bigint").alias("k"), F.lit("199803").alias("ciclo"), F.lit("extra").alias("valor"))
    for _ in range(2):  # the second run changes nothing
        S.merge_slice(change.unionByName(extra), path, ["k", "ciclo"], "valor", ["ciclo"], {"ciclo": "199803"})
    return S.read_partitioned(spark, path, ["ciclo"]).select("k", "ciclo", "valor")


@query("s16_partitioned_layout", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS ciclo, o_orderstatus AS sistema FROM orders WHERE strftime(o_orderdate, '%Y') = '1998'")
def s16(spark, sf):
    path = scratch(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("ciclo"), F.col("o_orderstatus").alias("sistema"))
    S.overwrite(orders, path, ["ciclo", "sistema"])
    stored = spark.read.option("recursiveFileLookup", False).parquet(path)
    return stored.where("ciclo >= '199801' AND ciclo <= '199812'").select("o_orderkey", F.col("ciclo").cast("string").alias("ciclo"), "sistema")


@query("s17_clustered_write", "SELECT l_orderkey, l_linenumber, l_shipdate::DATE::VARCHAR AS dia FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01'")
def s17(spark, sf):
    path = scratch(spark)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("dia"))
    S.cluster(lines, ["dia", "l_orderkey", "l_linenumber"]).write.parquet(path)
    return spark.read.parquet(path).where("dia >= DATE '1998-01-01' AND dia < DATE '1998-02-01'").withColumn("dia", F.col("dia").cast("string"))


@query(
    "s19_schema_diff",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS saldo, c_name || ' é' AS nota, 'nota' AS faltando, 'nome' AS sobrando FROM customer",
)
def s19(spark, sf):
    """A stored table whose schema has changed is rebuilt under the new one; one that fits is left alone."""
    path, wanted = scratch(spark), ["id", "saldo", "nota"]
    S.overwrite(customers(spark, sf), path)
    _, missing, extra = S.ensure_schema(spark.read.parquet(path), wanted)
    for _ in range(2):
        stored = spark.read.parquet(path)
        if not S.ensure_schema(stored, wanted)[0]:
            S.overwrite(stored.select("id", "saldo", F.col("nome").alias("nota")), path)
    return spark.read.parquet(path).select("*", F.lit(",".join(missing)).alias("faltando"), F.lit(",".join(extra)).alias("sobrando"))


@query("s14_create_table_as", f"{CUSTOMER_SQL} WHERE c_custkey % 2 = 1")
def s14(spark, sf):
    """A catalog table made from a query, replaced by another one, and read by a third."""
    name = f"ctas_{uuid.uuid4().hex}"
    S.create_table_as(customers(spark, sf).select("id"), name)
    S.create_table_as(R.sql_source(spark, "SELECT id, nome, saldo FROM {c} WHERE CAST(id AS BIGINT) % 2 = 1", c=customers(spark, sf)), name)
    return R.table(spark, name)


@query(
    "s12_merge_buckets",
    """SELECT c_custkey AS k, CASE WHEN c_custkey % 50 = 0 THEN 'novo' ELSE c_name END AS nome, (SELECT COUNT(*) FROM customer WHERE c_custkey % 50 = 0) AS atualizados, 1 AS inseridos, 0 AS repetidos FROM customer
UNION ALL SELECT -1, 'extra', (SELECT COUNT(*) FROM customer WHERE c_custkey % 50 = 0), 1, 0""",
)
def s12_buckets(spark, sf):
    path = scratch(spark)
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nome"))
    S.merge_buckets(base, path, ["k"], "nome", buckets=16)
    extra = table(spark, sf, "region").where("r_regionkey = 0").select(F.lit(-1).cast("bigint").alias("k"), F.lit("extra").alias("nome"))
    change = base.where("k % 50 = 0").withColumn("nome", F.lit("novo")).unionByName(extra)
    done, again = (S.merge_buckets(change, path, ["k"], "nome", buckets=16) for _ in range(2))
    counts = {"atualizados": done["update"], "inseridos": done["insert"], "repetidos": again["insert"] + again["update"]}
    return S.read_buckets(spark, path).select("*", *[F.lit(v).alias(n) for n, v in counts.items()])


@query("s21_write_csv", CUSTOMER_SQL.replace("c_acctbal AS", "CAST(c_acctbal AS DOUBLE) AS"))
def s21(spark, sf):
    path = scratch(spark)
    S.to_csv(customers(spark, sf), path, ";")
    return R.read_csv(spark, path, ";", customers(spark, sf).schema)
