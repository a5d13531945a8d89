import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType

from billproof.operators import quality as Q
from billproof.operators import sets as U
from billproof.operators import updates as X
from billproof.plans import standing as S
from billproof.plans import standing_layout as L
from billproof.sources import json_records as JR
from billproof.sources import readers as R
from billproof.sources import tables as T


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replace_slice_is_idempotent_and_empties_missing_values(spark, rows, tmp_path):
    path = str(tmp_path / "hub")
    first = rows("lote string, regra string, n int", [("07", "A", 1), ("07", "B", 2), ("06", "A", 3), ("07", "C", 4)])
    assert T.replace_slice(first, path, "lote", "07", "regra", ["A", "B", "C"]) == {"rows": 3, "A": 1, "B": 1, "C": 1}
    T.replace_slice(first, path, "lote", "06", "regra", ["A"])
    second = rows("lote string, regra string, n int", [("07", "A", 9)])
    for _ in range(2):
        assert T.replace_slice(second, path, "lote", "07", "regra", ["A", "B"]) == {"rows": 1, "A": 1, "B": 0}
    assert bag(spark.read.parquet(path).select("n", "regra")) == [(3, "A"), (4, "C"), (9, "A")]


def test_replace_whole_lot(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    T.replace_slice(rows("lote string, n int", [("2026-07", 1), ("2026-06", 2)]), path, "lote", "2026-07")
    T.replace_slice(rows("lote string, n int", [("2026-06", 2)]), path, "lote", "2026-06")
    T.replace_slice(rows("lote string, n int", []), path, "lote", "2026-07")
    assert [r.n for r in spark.read.parquet(path).collect()] == [2]


def test_upsert_snapshot_counts_and_keeps_old_versions(spark, rows, tmp_path):
    root = str(tmp_path / "s")
    assert T.read_snapshot(spark, root) is None
    assert T.upsert_snapshot(rows("k int, h string", [(1, "a"), (2, "b")]), root, ["k"], "h") == {"insert": 2, "update": 0}
    change = rows("k int, h string", [(1, "a"), (2, "x"), (3, "c")])
    assert T.upsert_snapshot(change, root, ["k"], "h") == {"insert": 1, "update": 1}
    assert T.upsert_snapshot(change, root, ["k"], "h") == {"insert": 0, "update": 0}
    assert bag(T.read_snapshot(spark, root)) == [(1, "a"), (2, "x"), (3, "c")]
    assert bag(spark.read.parquet(root + "/v000001")) == [(1, "a"), (2, "b")]


def test_merge_slice_touches_only_its_partition(spark, rows, tmp_path):
    path = str(tmp_path / "m")
    schema = "k int, h string, ciclo string, sistema string"
    args = (["k", "ciclo", "sistema"], "h", ["ciclo", "sistema"])
    first = rows(schema, [(1, "a", "202606", "NG"), (1, "a", "202607", "NG"), (2, "b", "202607", "ADAPTER")])
    assert T.merge_slice(first, path, *args, {}) == {"insert": 3, "update": 0}
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "m" / "ciclo=202606").rglob("*.parquet")}
    change = rows(schema, [(1, "z", "202607", "NG"), (3, "c", "202607", "NG")])
    assert T.merge_slice(change, path, *args, {"ciclo": "202607"}) == {"insert": 1, "update": 1}
    assert T.merge_slice(change, path, *args, {"ciclo": "202607"}) == {"insert": 0, "update": 0}
    got = T.read_partitioned(spark, path, ["ciclo", "sistema"]).select("k", "h", "ciclo", "sistema")
    assert bag(got) == [(1, "a", "202606", "NG"), (1, "z", "202607", "NG"), (2, "b", "202607", "ADAPTER"), (3, "c", "202607", "NG")]
    assert before and all(f.stat().st_mtime_ns == t for f, t in before.items())


def test_upsert_rejects_duplicate_source_keys(rows):
    target, source = rows("k int, v int", [(1, 1)]), rows("k int, v int", [(2, 1), (2, 2)])
    with pytest.raises(ValueError):
        X.upsert(target, source, ["k"])
    with pytest.raises(ValueError):
        X.upsert_changed(target, source, ["k"], "v")


def test_create_table_and_schema_policy(spark, rows):
    T.create_table_as(rows("a int, b int", [(1, 2)]), "ctas_check")
    try:
        assert T.ensure_schema(R.table(spark, "ctas_check"), ["a", "c"]) == (False, ["c"], ["b"])
        assert R.sql_source(spark, "SELECT a FROM {t}", t=R.table(spark, "ctas_check"), limit=5).count() == 1
    finally:
        spark.sql("DROP TABLE ctas_check")


def test_readers(spark, rows, tmp_path):
    sheet = tmp_path / "s.csv"
    sheet.write_text("﻿DOCUMENTO;NOME\n007;José\n;\n", encoding="utf-8")
    got = R.read_sheet(spark, str(sheet))
    assert got.columns == ["DOCUMENTO", "NOME"] and bag(got) == [("007", "José"), (None, None)]
    pipe = tmp_path / "p.txt"
    pipe.write_bytes("1|São Paulo|SP\n2||\n".encode("latin-1"))
    assert bag(R.read_pipe(spark, str(pipe), ["a", "b", "c"])) == [("1", "São Paulo", "SP"), ("2", None, None)]
    assert R.sniff_separator("a\tb\tc,d") == "\t" and R.sniff_separator("a") == ";"
    with pytest.raises(ValueError):
        R.read_dump(spark, "x", "xml")
    typed = R.to_df(spark, [{"a": "12", "b": "1.5", "c": "False"}, {"a": "x", "b": None, "c": "nan"}], {"a": LongType(), "b": DoubleType(), "c": BooleanType()})
    assert bag(typed) == [(12, 1.5, False), (None, None, None)]
    assert R.latest_lot(rows("l string", []), "l", "202607") == "2026-07"


def test_quality(rows):
    df = rows("a int, b string", [(1, None), (2, "x")])
    assert bag(Q.check(df, {"nulo": F.col("b").isNull(), "negativo": F.col("a") < 0})) == [("negativo", 0, True), ("nulo", 1, False)]
    assert Q.all_ok(Q.check(df, {"negativo": F.col("a") < 0})).first()[0]
    assert Q.parity(df, df.limit(1)).first().ok is False
    with pytest.raises(Q.EmptyStageError):
        Q.assert_not_empty(df.where("a > 5"), "x")
    with pytest.raises(ValueError):
        Q.require_columns(df, ["a", "z"])
    assert Q.schema_check(df, ["a"]) and not Q.schema_check(df, ["a"], exact=True)


def test_split_apply_null_side(rows):
    df = rows("r string", [("A",), ("B",), (None,)])
    assert bag(U.split_apply(df, F.col("r") == "A", lambda x: x)) == [("A",), ("B",)]
    assert len(bag(U.split_apply(df, F.col("r") == "A", lambda x: x, keep_null=True))) == 3


def test_evolve_is_tolerant(rows):
    df = rows("ASSET string, x int", [("a", 1)])
    once = X.evolve(df, {"ASSET": "SISTEMA"}, ["x", "y"], {"novo": "string"})
    twice = X.evolve(once, {"ASSET": "SISTEMA"}, ["x", "y"], {"novo": "string"})
    assert once.columns == twice.columns == ["SISTEMA", "novo"]


def test_standing_layout_sizes():
    assert len(L.STANDING_COLUMNS) == 99 and len(L.V1_COLUMNS) == 51
    for mapping in (L.NG, L.ADAPTER, L.SIMETRA):
        assert set(mapping) <= set(L.TARGETS)


def test_strict_mapping_demands_source_columns(rows):
    df = rows("FT_EMISSAO int", [(20260715,)])
    with pytest.raises(Exception):
        S.extract(df, "SIMETRA", "202607").count()
    out = S.extract(df, "SIMETRA", "2026-07", strict=False).first()
    assert out.ciclo_faturamento == "202607" and out.cancelada is None and str(out.data_emissao) == "2026-07-15"


def test_json_items(rows):
    texts = [
        '{"content":[{"codTrecho":"t","taxaIss":"5"}]}', '[{"aliquota":0,"aliq":2}]', "[]", "{bad", '{"aliquota":"x"}', None,
    ]
    got = JR.parse_rates(rows("i int, json string", list(enumerate(texts)))).orderBy("i").collect()
    assert [(r.status, r.codigo_trecho, r.aliquota) for r in got] == [
        ("ok", "t", 5.0), ("ok", None, 2.0), ("sem_dados", None, None), ("json_invalido", None, None), ("ok", None, None), ("json_invalido", None, None),
    ]


def test_section_rates(rows):
    texts = [
        '{"dados":[{"nomeContrato":"C","nomeTrecho":"N","aliquotas":[{"codigoTrecho":"1","aliquota":"2.5"},{"codigoTrecho":"2"}]}]}',
        '{"dados":[{"codigoContrato":"D","aliquota":3}]}', '{"dados":[]}', '{"sucesso":false}', "x", '{"dados":[{"aliquotas":[]}]}',
    ]
    got = JR.parse_section_rates(rows("i int, json string", list(enumerate(texts)))).orderBy("i", "codigo_trecho").collect()
    assert [(r.i, r.status, r.nome_contrato, r.codigo_trecho, r.aliquota) for r in got] == [
        (0, "ok", "C", "1", 2.5), (0, "ok", "C", "2", 0.0), (1, "ok", "D", None, 3.0), (2, "sem_dados", None, None, None),
        (3, "sem_dados", None, None, None), (4, "json_invalido", None, None, None), (5, "sem_trechos", None, None, None),
    ]


def test_flat_registry_layout(rows):
    raw = rows(
        "cnpj string, http_status int, json string, data_consulta string",
        [("1", 200, '{"razao_social":"A","cep":"1.234-567","capital_social":5,"opcao_pelo_mei":true,"nome_fantasia":"nan"}', "d"), ("2", 404, "x", "d"), ("3", None, None, "d")],
    )
    a, b, c = JR.normalise_registry(raw, "flat").orderBy("cnpj").collect()
    assert (a.razao_social, a.receita_cep, a.capital_social, a.opcao_mei, a.nome_fantasia, a.status_consulta) == ("A", "01234567", 5.0, True, None, "ok")
    assert (b.status_consulta, b.razao_social, c.status_consulta) == ("erro_http_404", None, "timeout")


def _ranges(path, column):
    """(min, max) of a column in each file, from the footers."""
    import pyarrow.parquet as pq

    found = []
    for f in sorted(path.glob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == column)
        own = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        found.append((min(s.min for s in own), max(s.max for s in own)))
    return found


def test_clustering_prunes_by_every_column(spark, tmp_path):
    mixed = [F.pmod(F.xxhash64(F.lit(s), "id"), F.lit(1000)) for s in range(4)]
    day = F.date_add(F.lit("2026-01-01").cast("date"), mixed[3].cast("int"))
    rows = spark.range(40_000).select(mixed[0].alias("a"), (mixed[1] / 7).alias("b"), F.format_string("k%04d", mixed[2]).alias("c"), day.alias("d"))
    out = tmp_path / "c"
    T.cluster(rows.unionByName(rows.limit(50).select(*[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes])), ["a", "b", "c", "d"], files=64).write.parquet(str(out))
    assert spark.read.parquet(str(out)).count() == 40_050
    import datetime as dt

    wanted = {"a": [100, 500, 900], "b": [10.0, 70.0, 130.0], "c": ["k0100", "k0500", "k0900"], "d": [dt.date(2026, 4, 11), dt.date(2027, 5, 16), dt.date(2028, 6, 19)]}
    for column, values in wanted.items():
        files = _ranges(out, column)
        for v in values:
            read = sum(low <= v <= high for low, high in files) / len(files)
            assert read < (0.5 if column in "ab" else 0.7), (column, v, read)  # a sort by the first column reads all for the others


def test_merge_rewrites_changed_buckets_only(spark, tmp_path):
    path = str(tmp_path / "m")
    base = spark.range(5000).select("id", F.lit("x").alias("h"))
    assert T.merge_buckets(base, path, ["id"], "h", buckets=32) == {"insert": 5000, "update": 0}
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "m").rglob("*.parquet")}
    before = files()
    few = base.where(F.pmod(F.xxhash64("id"), F.lit(32)).isin(3, 17)).limit(50)
    change = few.withColumn("h", F.lit("y")).unionByName(base.where("id % 7 = 0 AND h = 'x'").join(few, "id", "left_anti"))
    assert T.merge_buckets(change, path, ["id"], "h", buckets=32) == {"insert": 0, "update": 50}
    after = files()
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.parent.name for f in before if f not in same} == {"_bucket=3", "_bucket=17"}
    assert T.merge_buckets(change, path, ["id"], "h", buckets=32) == {"insert": 0, "update": 0} and files() == after
    assert T.merge_buckets(spark.range(9000, 9003).select("id", F.lit("z").alias("h")), path, ["id"], "h", buckets=32) == {"insert": 3, "update": 0}
    got = T.read_buckets(spark, path).groupBy("h").count()
    assert {r.h: r["count"] for r in got.collect()} == {"x": 4950, "y": 50, "z": 3}
    with pytest.raises(ValueError):
        T.merge_buckets(base.unionByName(base.limit(1)), path, ["id"], "h", buckets=32)
