"""Behaviour groups, outliers, severity model and priority panels over the billing base."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import decimal_comma
from ..functions.text import label_chain, prepare_category
from ..operators import clusters, isolation
from ..operators.aggregates import ordered_distribution
from ..operators.joins import cross_one_row
from ..operators.selection import mark_first, ordered_code
from ..session import stored
from .dataset import standardise, stratified_split

# Columns of the billing base, features, labels and thresholds.
NUMBERS = [
    "faturamento_atual", "faturamento_mes_anterior", "media_faturamento_6m", "desvio_padrao_6m",
    "qtde_meses_historico", "dispersao_abs_mes_anterior", "dispersao_pct_mes_anterior", "dispersao_abs_media_6m",
    "dispersao_pct_media_6m", "score_anomalia", "valor_contrato",
]
CATEGORIES = [
    "SEGMENTO", "PRODUTO", "ITEM_FATURAMENTO", "UF", "MUNICIPIO", "TIPO_CLIENTE", "STATUS_CLIENTE",
    "tipo_dispersao_mes_anterior", "tipo_dispersao_media_6m", "severidade", "classificacao_final", "flag_anomalia",
    "status_contrato", "crm", "nome_produto",
]
FEATURES = [
    "faturamento_atual", "faturamento_mes_anterior", "media_faturamento_6m", "desvio_padrao_6m",
    "dispersao_pct_mes_anterior", "dispersao_pct_media_6m", "score_anomalia", "qtde_meses_historico",
]
SEVERITIES = ["BAIXA", "MEDIA", "ALTA", "CRITICA"]
SEVERITY_ORDER = ["CRITICA", "ALTA", "MEDIA", "BAIXA", "SEM_HISTORICO"]
RISK_HIGH, RISK_MEDIUM, RISK_LOW = "🔴 ALTO", "🟡 MÉDIO", "🟢 BAIXO"
NORMAL, ANOMALY = "NORMAL", "⚠️ ANOMALIA"
MOTIVE_WORDS = "CRITICO|ANOMALIA|ALERTA"
MOTIVE_LABELS = {"ANOMALIA_ML": "SINAL FORA DO PADRÃO"}
MIN_LABELLED = 200
TREES = 150


class TooFewLabels(ValueError):
    """Not enough labelled rows to train the severity model."""


def prepare_base(df: DataFrame) -> DataFrame:
    """Numbers from text (decimal comma, unreadable -> 0) and categories trimmed, upper-case, 'N/A' for NULL."""
    return df.select(
        *[
            decimal_comma(F.col(c)).alias(c) if c in NUMBERS else prepare_category(F.col(c)).alias(c) if c in CATEGORIES else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def features_of(df: DataFrame) -> list[str]:
    return [c for c in FEATURES if c in df.columns]


def _vector(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="_features", handleInvalid="keep")


def kmeans(
    df: DataFrame, k: int = 6, seed: int = 42, n_init: int = 10, columns: Sequence[str] | None = None, rounds: int = 20
) -> tuple[DataFrame, clusters.Fit]:
    """Groups on standardised features: the best of n_init starts by cost. Adds `cluster`. All starts advance together."""
    names = list(columns or features_of(df))
    copies = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}") for c in names])
    scaled = stored(standardise(copies, [f"_x_{c}" for c in names]), "scaled")
    features = [f"_x_{c}" for c in names]
    best = clusters.fit(scaled.select(*features), k, seed, n_init, rounds)
    return scaled.withColumn("cluster", clusters.nearest(best.centres, features)).drop(*features), best


def cluster_profile(df: DataFrame) -> DataFrame:
    """Size, mean billing, mean score and problem shares per cluster, with a risk label."""

    def share(column: str, value: str) -> Column:
        if column not in df.columns:
            return F.count(F.lit(1)).cast("double")
        return F.round(F.avg(F.when(F.col(column) == value, 1.0).otherwise(0.0)) * 100, 1)

    score = F.avg("score_anomalia") if "score_anomalia" in df.columns else F.count(F.lit(1)).cast("double")
    out = df.groupBy("cluster").agg(
        F.count("faturamento_atual").alias("registros"),
        F.round(F.avg("faturamento_atual"), 2).alias("media_faturamento"),
        F.round(score, 2).alias("score_medio"),
        share("flag_anomalia", "S").alias("pct_anomalia"),
        share("severidade", "CRITICA").alias("pct_critico"),
        share("tipo_dispersao_mes_anterior", "DISPERSAO_NEGATIVA").alias("disp_neg_pct"),
    )
    c = F.col
    risk = label_chain(
        [
            ((c("pct_critico") > 30) | (c("score_medio") > 2), RISK_HIGH),
            ((c("pct_anomalia") > 20) | (c("disp_neg_pct") > 40), RISK_MEDIUM),
        ],
        RISK_LOW,
    )
    return out.withColumn("risco", risk)


def attach_risk(df: DataFrame, profile: DataFrame) -> DataFrame:
    """risco_cluster of each row's cluster (one profile row per cluster)."""
    return df.join(profile.select("cluster", F.col("risco").alias("risco_cluster")), "cluster", "left")


def distance_score(df: DataFrame, columns: Sequence[str] | None = None, name: str = "score_distancia") -> DataFrame:
    """Adds the squared distance from the mean in standardised features (NULL counts as 0)."""
    names = list(columns or features_of(df))
    copies = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}") for c in names])
    scaled = standardise(copies, [f"_x_{c}" for c in names])
    distance = sum((F.col(f"_x_{c}") * F.col(f"_x_{c}") for c in names), F.lit(0.0))
    return scaled.withColumn(name, distance).drop(*[f"_x_{c}" for c in names])


def outliers(
    df: DataFrame, contamination: float = 0.08, columns: Sequence[str] | None = None, trees: int = isolation.TREES, sample: int = isolation.SAMPLE, seed: int = 42
) -> DataFrame:
    """Adds score_isolamento (isolation forest, 0 to 1) and anomalia_iso.

    Trees are grown on at most trees * sample rows; every row is scored. Exactly ceil(contamination * n) rows with the
    highest scores are flagged; rows that tie at the limit are told apart by hash, equal rows one by one.
    """
    names = list(columns or features_of(df))
    n = df.count()
    forest = isolation.grow(isolation.sampled(df, names, n, trees * sample), trees, sample, seed)
    scored = df.withColumn("score_isolamento", isolation.isolation_score(forest, names))
    tie = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns])
    quota = F.ceil(F.col("_n") * F.lit(contamination)).alias("_quota")
    marked = mark_first(scored, [], [-ordered_code(F.col("score_isolamento")), tie], lambda sizes: sizes.select(quota), "_out")
    return marked.withColumn("anomalia_iso", F.when(F.col("_out"), ANOMALY).otherwise(NORMAL)).drop("_out")


def label_encode(df: DataFrame, column: str, name: str):
    """(encoded table, model): labels numbered in alphabetical order."""
    model = StringIndexer(inputCol=column, outputCol=name, stringOrderType="alphabetAsc", handleInvalid="error").fit(df)
    return model.transform(df), model


def label_decode(df: DataFrame, column: str, name: str, labels: Sequence[str]) -> DataFrame:
    return IndexToString(inputCol=column, outputCol=name, labels=list(labels)).transform(df)


def class_weights(df: DataFrame, label: str, name: str = "_weight") -> DataFrame:
    """Balanced weights: n / (number of classes * rows of the class)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = sizes.agg(F.sum("_n").alias("_t"), F.count(F.lit(1)).alias("_k"))
    weights = cross_one_row(sizes, totals).select(label, (F.col("_t") / (F.col("_k") * F.col("_n"))).alias(name))
    return df.join(F.broadcast(weights), label)  # a row for each class: a class's rows needn't meet


def fit_severity(
    df: DataFrame, label: str = "severidade", key: Sequence[str] | None = None, trees: int = TREES, seed: int = 42, columns: Sequence[str] | None = None
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, test part, importances): random forest with balanced class weights on a stratified 80 % of the labelled rows."""
    names = list(columns or features_of(df))
    labelled = df.where(F.col(label).isin(*SEVERITIES)).select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names], label, *[c for c in (key or []) if c not in (*names, label)])
    n = labelled.count()
    if n < MIN_LABELLED:
        raise TooFewLabels(f"{n} labelled rows, {MIN_LABELLED} needed")
    train, test = stratified_split(labelled, label, 0.2, seed, key)
    indexer = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc").fit(labelled)
    forest = RandomForestClassifier(featuresCol="_features", labelCol="_y", weightCol="_weight", numTrees=trees, seed=seed, predictionCol="_p")
    decode = IndexToString(inputCol="_p", outputCol="severidade_prevista", labels=indexer.labels)
    weighted = indexer.transform(class_weights(train, label))
    fitted = Pipeline(stages=[_vector(names), forest]).fit(weighted)
    model = PipelineModel([*fitted.stages, decode])
    gains = [float(x) for x in fitted.stages[1].featureImportances.toArray()]
    spark = df.sparkSession
    importances = spark.createDataFrame(sorted(zip(names, gains), key=lambda p: -p[1]), "variavel string, importancia double")
    return model, test, importances


def predict_severity(model: PipelineModel, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds severidade_prevista to every row."""
    names = list(columns or features_of(df))
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names})
    out = model.transform(filled)
    return out.select(*df.columns, "severidade_prevista")


# -- panels -----------------------------------------------------------------------------------------------------------


def priority_by(df: DataFrame, dimension: str, n: int | None = 10) -> DataFrame:
    """Ranking of a dimension's values by .5 * critical % + .3 * attention % + .2 * share of the largest impact."""
    c = F.col
    aggs = [
        F.count("faturamento_atual").alias("volume_contratos"),
        F.sum("faturamento_atual").alias("impacto_financeiro"),
        F.avg("faturamento_atual").alias("ticket_medio"),
    ]
    flags = {
        "ocorrencias_atencao": ("flag_anomalia", "S"),
        "ocorrencias_criticas": ("severidade", "CRITICA"),
        "disp_negativa": ("tipo_dispersao_mes_anterior", "DISPERSAO_NEGATIVA"),
    }
    present = {name: pair for name, pair in flags.items() if pair[0] in df.columns}
    aggs += [F.count_if(c(column) == value).alias(name) for name, (column, value) in present.items()]
    grouped = df.groupBy(dimension).agg(*aggs)
    largest = grouped.agg(F.greatest(F.max("impacto_financeiro").cast("double"), F.lit(1.0)).alias("_max"))
    out = cross_one_row(grouped, largest)
    zero = F.lit(0.0)
    pct = lambda name: F.round(c(name) / c("volume_contratos") * 100, 1)
    attention = pct("ocorrencias_atencao") if "ocorrencias_atencao" in present else zero
    critical = pct("ocorrencias_criticas") if "ocorrencias_criticas" in present else zero
    share = c("impacto_financeiro").cast("double") / c("_max") * 100
    ranked = out.withColumns({"pct_atencao": attention, "pct_critica": critical}).withColumn(
        "indice_prioridade", F.round(c("pct_critica") * 0.5 + c("pct_atencao") * 0.3 + share * 0.2, 1)
    )
    kept = ranked.drop("_max")
    return kept if n is None else kept.orderBy(F.desc("indice_prioridade"), F.col(dimension)).limit(n)


def severity_distribution(df: DataFrame) -> DataFrame:
    return ordered_distribution(df, "severidade", SEVERITY_ORDER)


def top_motives(df: DataFrame, n: int = 8, labels: Mapping[str, str] = MOTIVE_LABELS) -> DataFrame:
    """Most frequent final classifications that name a problem."""
    hits = df.where(F.col("classificacao_final").rlike(MOTIVE_WORDS))
    top = hits.groupBy("classificacao_final").agg(F.count(F.lit(1)).alias("volume")).orderBy(F.desc("volume"), "classificacao_final").limit(n)
    motive = label_chain([(F.col("classificacao_final") == k, v) for k, v in labels.items()], F.col("classificacao_final"))
    return top.select(motive.alias("motivo"), "volume")


def executive_summary(df: DataFrame) -> DataFrame:
    """One row: portfolio size, urgent share, falls, rises, contracts without billing."""
    c = F.col
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(c("severidade").isin("CRITICA", "ALTA")).alias("carteira_prioritaria"),
        F.count_if(c("tipo_dispersao_mes_anterior") == "DISPERSAO_NEGATIVA").alias("queda_faturamento"),
        F.count_if(c("tipo_dispersao_mes_anterior") == "DISPERSAO_POSITIVA").alias("alta_faturamento"),
        F.count_if(c("faturamento_atual") == 0).alias("sem_faturamento"),
    )
