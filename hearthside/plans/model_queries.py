"""Split, encoding, scaling, metrics and price models."""

from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.extract import enrich
from hearthside.functions.features import engineer, one_hot
from hearthside.functions.text import amenity_flags
from hearthside.operators import attribution, deals, encode, market, models, search_space
from hearthside.plans.fixture import AS_OF, listings, text_listings
from hearthside.plans.preparation import frames, prepare, train_price_model
from hearthside.plans.registry import query
from hearthside.session import cut_lineage

_BUCKET = "CAST(concat('0x', substr(md5(row_key), 1, 8)) AS BIGINT) % 100"


@query("hash_split", f"SELECT row_key, {_BUCKET} < 15 AS is_test, round(ln(1 + price_numeric), 8) AS target FROM listings_fx")
def hash_split(spark, sf_dir):
    df = encode.with_target(listings(spark, sf_dir)).select("row_key", F.round("target", 8).alias("target"))
    train, test = encode.split(df, "row_key")
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


_ENCODED = ["city", "property_type", "seller_name", "finish_truth"]
_TRAIN = f", y AS (SELECT *, ln(1 + price_numeric) AS target, {_BUCKET} AS b FROM listings_fx), tr AS (SELECT * FROM y WHERE b >= 15), te AS (SELECT * FROM y WHERE b < 15), pr AS (SELECT avg(target) AS prior FROM tr)"
_CODES = "".join(
    f", c{i} AS (SELECT {c} AS v, prior * (1 - 1 / (1 + exp(-(count(*) - 20) / 10.0))) + avg(target) * (1 / (1 + exp(-(count(*) - 20) / 10.0))) AS code FROM tr, pr WHERE {c} IS NOT NULL GROUP BY {c}, prior)"
    for i, c in enumerate(_ENCODED)
)


@query(
    "target_encoded",
    _TRAIN
    + _CODES
    + "SELECT row_key, "
    + ", ".join(f"round(coalesce(c{i}.code, prior), 6) AS {c}" for i, c in enumerate(_ENCODED))
    + " FROM te CROSS JOIN pr "
    + " ".join(f"LEFT JOIN c{i} ON te.{c} = c{i}.v" for i, c in enumerate(_ENCODED)),
)
def target_encoded(spark, sf_dir):
    df = encode.with_target(listings(spark, sf_dir)).select("row_key", "target", *_ENCODED)
    train, test = encode.split(df, "row_key")
    coded = encode.fit_target_encoding(train, _ENCODED).apply(test)
    return coded.select("row_key", *[F.round(c, 6).alias(c) for c in _ENCODED])


_SCALED = ["price_numeric", "area_sqm", "bedrooms", "latitude"]


@query(
    "standard_scaled",
    _TRAIN
    + ", m AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
    + " FROM tr) SELECT row_key, "
    + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALED)
    + ", CAST(0 AS DOUBLE) AS fixed FROM te, m",
)
def standard_scaled(spark, sf_dir):
    df = listings(spark, sf_dir).select("row_key", *_SCALED).withColumn("fixed", F.lit(7.0))
    train, test = encode.split(df, "row_key")
    scaled = encode.fit_scaling(train, [*_SCALED, "fixed"]).apply(test)
    return scaled.select("row_key", *[F.round(c, 6).alias(c) for c in _SCALED], "fixed")


_GUESSES = """, p AS (SELECT *, ln(1 + price_numeric) AS y, ln(1 + price_numeric) + (part_no % 21 - 10) / 50.0 AS a, ln(1 + price_numeric) * 0.9 + 1 AS b FROM listings_fx)"""


def guessed(spark, sf_dir):
    """Two stand-in predictions around the target."""
    y = F.log1p("price_numeric")
    return listings(spark, sf_dir).select(
        "row_key", y.alias("target"), (y + (F.col("part_no") % 21 - 10) / F.lit(50.0)).alias("a"), (y * 0.9 + 1).alias("b")
    )


def _metrics_sql(name):
    return f"""SELECT '{name}' AS name, round(1 - sum((y - {name}) * (y - {name})) / sum((y - m) * (y - m)), 6) AS r2, round(sqrt(avg((y - {name}) * (y - {name}))), 6) AS rmse_log,
    round(avg(abs(exp(y) - exp({name}))), 2) AS mae, round(sqrt(avg((exp(y) - exp({name})) * (exp(y) - exp({name})))), 2) AS rmse,
    round(avg(abs(exp(y) - exp({name})) / greatest(exp(y) - 1, 1)) * 100, 4) AS mape FROM p, (SELECT avg(y) AS m FROM p)"""


_METRIC_DIGITS = {"r2": 6, "rmse_log": 6, "mae": 2, "rmse": 2, "mape": 4}


def _rounded_metrics(df):
    return df.withColumns({c: F.round(c, d) for c, d in _METRIC_DIGITS.items()})


@query("regression_metrics", _GUESSES + _metrics_sql("a") + " UNION ALL " + _metrics_sql("b"))
def regression_metrics(spark, sf_dir):
    return _rounded_metrics(models.metrics(guessed(spark, sf_dir), {"a": "a", "b": "b"}))


@query(
    "residual_histogram",
    _GUESSES
    + """, r AS (SELECT y - b AS x FROM p), e AS (SELECT min(x) AS lo, max(x) AS hi FROM r)
    SELECT CAST(least(floor((x - lo) / (hi - lo) * 50), 49) AS INT) AS bin, count(*) AS n FROM r, e GROUP BY 1""",
)
def residual_histogram(spark, sf_dir):
    spread = models.residuals(guessed(spark, sf_dir), "b")
    return market.histogram(spread, F.col("residual"), 50).where("n > 0").select("bin", "n")


@query(
    "blend_moments",
    _GUESSES
    + "SELECT count(*) AS n, round(sum(y * y), 2) AS yy, round(sum(a * y), 2) AS py_0, round(sum(a * a), 2) AS pp_0_0, round(sum(a * b), 2) AS pp_0_1, round(sum(b * y), 2) AS py_1, round(sum(b * b), 2) AS pp_1_1 FROM p",
)
def blend_moments(spark, sf_dir):
    found = models.blend_moments(guessed(spark, sf_dir), ["a", "b"])
    return found.withColumns({c: F.round(c, 2) for c in found.columns if c != "n"})


@query(
    "blend_weights",
    _GUESSES
    + """, w AS (SELECT least(1, greatest(0, sum((y - b) * (a - b)) / sum((a - b) * (a - b)))) AS wa FROM p)
    SELECT 'a' AS model, round(wa, 6) AS weight FROM w UNION ALL SELECT 'b', round(1 - wa, 6) FROM w""",
)
def blend_weights(spark, sf_dir):
    weights = models.blend_weights(guessed(spark, sf_dir), ["a", "b"])
    rows = [(name, round(w, 6)) for name, w in weights.items()]
    return spark.createDataFrame(rows, "model string, weight double")


def processed(spark, sf_dir):
    """Listings with all model columns."""
    df = listings(spark, sf_dir)
    view = F.when(F.col("line_no") % 4 == 0, "garden").when(F.col("line_no") % 4 == 1, "sea").otherwise("unknown")
    named = df.select(
        "row_key", "price_numeric", "area_sqm", F.col("area_sqm").alias("area_numeric"), "bedrooms", "bathrooms",
        "latitude", "longitude", F.lower("property_type").alias("property_type"), F.lower("city").alias("city"),
        F.lower("governorate").alias("governorate"), F.coalesce("finish_truth", F.lit("unknown")).alias("finish_type"),
        F.lower("seller_name").alias("seller_name"), view.alias("view_type"),
        F.coalesce(F.lower("title"), F.lit("unknown")).alias("compound_name"), F.col("delivery_months").alias("delivery_date"),
        F.coalesce("furnished", F.lit("unknown")).alias("furnished"), "ownership", "payment_option", "completion_status", "seller_type",
        *[f.cast("int").alias(n) for n, f in amenity_flags(F.col("listed_amenities")).items()],
        (F.col("size_no") % 9 == 0).cast("int").alias("roof"),
    )
    return engineer(one_hot(named))


def ready_frames(spark, sf_dir):
    return frames(processed(spark, sf_dir), "row_key")


@query("prepared_listings")
def prepared_listings(spark, sf_dir):
    """Cleaning from raw-like rows to the processed table."""
    df = text_listings(spark, sf_dir)
    raw = enrich(
        df.select(
            "ad_id", "title", F.format_number("price_numeric", 0).alias("price"), "price_numeric", "description",
            F.col("bedrooms").cast("string").alias("bedrooms"), F.col("bathrooms").cast("string").alias("bathrooms"),
            F.nullif("area_sqm", F.lit(0.0)).cast("string").alias("area_sqm"), F.nullif("area_sqm", F.lit(0.0)).alias("area_numeric"),
            "property_type", "city", "governorate", "latitude", "longitude",
            F.concat("seller_name", F.lit(" Member since 2020")).alias("seller_name"), "seller_type", "furnished", "ownership",
            "payment_option", "completion_status", F.col("listed_amenities").alias("amenities"),
            F.concat(F.col("line_no").cast("string"), F.lit(" days ago")).alias("posted_date"), F.lit(None).cast("string").alias("down_payment"),
            F.lit(1.0).alias("price_per_sqm"), F.lit("u").alias("url"), F.lit("i").alias("image_url"), F.lit("t").alias("scrape_timestamp"),
        )
    )
    found = prepare(raw, F.lit(AS_OF).cast("date"))
    return found.select(*[F.col(f"`{c}`") for c in vocab.MODEL_COLUMNS], "price_numeric")


# Models are fitted with the library's settings on prices of known form, so that every score has an exact expected value.
# Trees may look at all columns in every node; boosting ends early once the held-back part of the rows is met.
_ALL = {"featureSubsetStrategy": "all"}
_KNOWN = f""", kn AS (SELECT *, 1000000 * (CASE WHEN completion_status = 'ready' THEN 2 ELSE 1 END) * (CASE WHEN ownership = 'primary' THEN 3 ELSE 1 END) AS known FROM listings_fx),
y AS (SELECT *, ln(1 + known) AS y, {_BUCKET} AS b FROM kn), tr AS (SELECT * FROM y WHERE b >= 15), te AS (SELECT * FROM y WHERE b < 15)"""


def known(spark, sf_dir):
    """Listings whose price is 1, 2, 3 or 6 million by completion status and ownership."""
    price = 1e6 * F.when(F.col("completion_status_ready") == 1, 2.0).otherwise(1.0) * F.when(F.col("ownership_primary") == 1, 3.0).otherwise(1.0)
    return processed(spark, sf_dir).withColumn("price_numeric", price)


@query("gbt_scores", _KNOWN + " SELECT row_key, round(y, 6) AS target, round(y, 6) AS prediction FROM te")
def gbt_scores(spark, sf_dir):
    fitted, ready = train_price_model(known(spark, sf_dir), "row_key", **_ALL)
    return fitted.model.transform(ready.test).select("row_key", F.round("target", 6).alias("target"), F.round("prediction", 6).alias("prediction"))


@query("linear_scores")
def linear_scores(spark, sf_dir):
    """Plain, ridge and lasso baselines side by side."""
    ready = ready_frames(spark, sf_dir)
    return _linear(ready.train, ready.test, ready.columns)


def _linear(train, test, columns):
    """The fits with a penalty share one scan. Without one, columns that add up to one leave the solution to the last bits of
    the sums, so that fit stays on the rows themselves."""
    few, wide = models.moment_rows(train, columns), test
    for name, params in {
        "plain": {}, "ridge": {"regParam": 0.01, "elasticNetParam": 0.0}, "lasso": {"regParam": 0.001, "elasticNetParam": 1.0},
    }.items():
        fit = models.linear(columns, name, weightCol="weight", **params).fit(few) if params else models.linear(columns, name).fit(train)
        wide = fit.transform(wide).drop("features")
    return wide.select("row_key", *[F.round(c, 6).alias(c) for c in ("target", "plain", "ridge", "lasso")])


@query(
    "linear_by_area",
    f""", y AS (SELECT *, ln(1 + price_numeric) AS y, {_BUCKET} AS b FROM listings_fx), tr AS (SELECT * FROM y WHERE b >= 15), te AS (SELECT * FROM y WHERE b < 15),
    m AS (SELECT avg(area_sqm) AS mx, avg(y) AS my, stddev_pop(area_sqm) AS sx, stddev_pop(y) AS sy, corr(area_sqm, y) AS r FROM tr),
    s AS (SELECT *, sy / sx * r AS plain, sy / sx * r / (1 + 0.01 / sy) AS ridge, sy / sx * sign(r) * greatest(abs(r) - 0.001 / sy, 0) AS lasso FROM m)
    SELECT row_key, round(y, 6) AS target, """
    + ", ".join(f"round(my + {c} * (area_sqm - mx), 6) AS {c}" for c in ("plain", "ridge", "lasso"))
    + " FROM te, s",
)
def linear_by_area(spark, sf_dir):
    """The three regressions of the log price on the area alone, which have closed forms."""
    rows = cut_lineage(encode.with_target(listings(spark, sf_dir)).select("row_key", "target", "area_sqm"))  # six passes follow
    return _linear(*encode.split(rows, "row_key"), ["area_sqm"])


_FOLD = "CAST(concat('0x', substr(md5(concat('fold:', row_key)), 1, 8)) AS BIGINT) % 5"


_FOLDED = ["city", "seller_name"]
_FOLD_SQL = (
    f""", tr AS (SELECT *, ln(1 + price_numeric) AS y, {_FOLD} AS f FROM listings_fx WHERE {_BUCKET} >= 15), fs AS (SELECT DISTINCT f FROM tr),
    vs AS (SELECT * FROM (SELECT f AS own FROM fs), (SELECT -1 AS k UNION ALL SELECT 0)),
    pr AS (SELECT own, k, avg(y) AS prior FROM tr, vs WHERE f <> own AND f <> k GROUP BY ALL)"""
    + "".join(
        f""", c_{c} AS (SELECT own, k, {c} AS v, avg(prior) * (1 - 1 / (1 + exp(-(count(*) - 20) / 10.0))) + avg(y) * (1 / (1 + exp(-(count(*) - 20) / 10.0))) AS code
        FROM tr JOIN pr ON f <> own AND f <> k GROUP BY ALL)"""
        for c in _FOLDED
    )
    + " SELECT row_key, f AS fold"
    + "".join(f", round(coalesce({c}_{n}.code, {n}.prior), 6) AS {c}_{n}" for c in _FOLDED for n in ("own", "first"))
    + " FROM tr JOIN pr own ON own.own = f AND own.k = -1 JOIN pr first ON first.own = f AND first.k = 0"
    + "".join(
        f" LEFT JOIN c_{c} {c}_{n} ON {c}_{n}.own = f AND {c}_{n}.k = {k} AND {c}_{n}.v = tr.{c}" for c in _FOLDED for n, k in (("own", -1), ("first", 0))
    )
)


@query("fold_encoded", _FOLD_SQL)
def fold_encoded(spark, sf_dir):
    """Codes of the training rows without their own fold, and those in the fit that leaves fold 0 out."""
    df = encode.with_target(listings(spark, sf_dir)).select("row_key", "target", *_FOLDED)
    train = encode.with_folds(encode.split(df, "row_key")[0], "row_key")
    coded = encode.fit_fold_encoding(train, _FOLDED, 5).apply(train)
    own = [F.round(F.col(c)[5], 6).alias(f"{c}_own") for c in _FOLDED]
    return coded.select("row_key", "fold", *own, *[F.round(F.col(c)[0], 6).alias(f"{c}_first") for c in _FOLDED])


def _bases(columns):
    return {"boosted": models.early_boosted(columns, "boosted", **_ALL), "forest": models.forest(columns, "forest", **_ALL)}


# both base models meet the target, so the ridge on two equal columns only shrinks it towards the training mean
_SHRUNK = _KNOWN + """, w AS (SELECT avg(y) AS my, var_pop(y) * count(*) / (var_pop(y) * count(*) + 0.5 / stddev_pop(y)) AS w FROM tr),
p AS (SELECT row_key, y, y AS boosted, y AS forest, my + w * (y - my) AS stacked, y AS blended FROM te, w)"""


@query("stacked_scores", _SHRUNK + "SELECT row_key, round(y, 6) AS target, round(boosted, 6) AS boosted, round(forest, 6) AS forest, round(stacked, 6) AS stacked FROM p")
def stacked_scores(spark, sf_dir):
    ready = frames(known(spark, sf_dir), "row_key")
    stack = models.fit_stack(ready.train, "row_key", _bases(ready.columns), views=ready.folded())
    return models.predict_stack(ready.test, stack).select(
        "row_key", *[F.round(c, 6).alias(c) for c in ("target", "boosted", "forest", "stacked")]
    )


@query("tuned_model", "SELECT 'tuned' AS name, 1.0::DOUBLE AS r2, 0.0::DOUBLE AS rmse_log, 0.0::DOUBLE AS mae, 0.0::DOUBLE AS rmse, 0.0::DOUBLE AS mape, 50 AS trials FROM listings_fx LIMIT 1")
def tuned_model(spark, sf_dir):
    ready = frames(known(spark, sf_dir), "row_key")
    # the published ranges, trials and folds; every node sees all columns, which is more work a node and makes the answer exact
    space = {**search_space.SPACE, "featureSubsetStrategy": search_space.Setting(1.0, 1.0, text=True)}
    model, study = search_space.tune(ready.train, ready.folded(), "row_key", ready.columns, space=space)
    board = _rounded_metrics(models.metrics(model.transform(ready.test), {"tuned": "prediction"}))
    return board.withColumn("trials", F.lit(len(study.trials)))


_EXPLAINED = f""", y AS (SELECT *, CASE WHEN size_no % 9 = 0 THEN ln(1 + 2000000) ELSE ln(1 + 1000000) END AS y, {_BUCKET} AS b,
  CAST(concat('0x', substr(md5(concat('early:', row_key)), 1, 8)) AS BIGINT) % 100 AS e, md5(concat('explain:', row_key)) AS h FROM listings_fx),
bs AS (SELECT avg(y) AS base FROM y WHERE b >= 15 AND e >= 10),
te AS (SELECT *, CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) % 8 AS g FROM y WHERE b < 15),
ls AS (SELECT g, max_by(y, h) AS last FROM te GROUP BY g),
sw AS (SELECT avg((y - other) * (y - other)) AS rise FROM (SELECT y, coalesce(lag(y) OVER (PARTITION BY te.g ORDER BY h, row_key), last) AS other FROM te JOIN ls ON te.g = ls.g)),
fe AS (SELECT unnest([{", ".join(f"'{c}'" for c in vocab.MODEL_COLUMNS)}]) AS feature)
SELECT feature, round(CASE WHEN feature <> 'roof' THEN 0 WHEN kind = 'splits' THEN 1 WHEN kind = 'contribution' THEN (SELECT avg(abs(y - base)) FROM te, bs) ELSE (SELECT rise FROM sw) END, 6) AS importance, kind
FROM fe, (SELECT unnest(['splits', 'contribution', 'permutation']) AS kind)"""


@query("importances", _EXPLAINED)
def importances(spark, sf_dir):
    """Three kinds of attribution of a price that depends on the roof alone."""
    table = processed(spark, sf_dir).withColumn("price_numeric", F.when(F.col("roof") == 1, 2e6).otherwise(1e6))
    fitted, ready = train_price_model(table, "row_key", subsamplingRate=1.0, **_ALL)
    n = len(ready.columns)
    found = {
        "splits": models.tree_importances(fitted.model, ready.columns, spark, top=n),
        "contribution": attribution.mean_attribution(attribution.attribute(fitted.model, ready.test, ready.columns), ready.columns),
        "permutation": models.permutation_importances(fitted.model, ready.test, "row_key", ready.columns, buckets=8, top=n),
    }
    wide = [df.select("feature", (F.round("importance", 6) + 0.0).alias("importance"), F.lit(kind).alias("kind")) for kind, df in found.items()]
    return wide[0].unionByName(wide[1]).unionByName(wide[2])


@query(
    "leaderboard",
    _SHRUNK
    + " UNION ALL ".join("(" + _metrics_sql(n) + ")" for n in ("boosted", "forest", "stacked", "blended")),
)
def leaderboard(spark, sf_dir):
    """Base models, stack and blend; blend weights come from out-of-fold predictions."""
    ready = frames(known(spark, sf_dir), "row_key")
    stack = models.fit_stack(ready.train, "row_key", _bases(ready.columns), views=ready.folded())
    names = ["boosted", "forest", "stacked"]
    weights = models.blend_weights(stack.out_of_fold, names)
    wide = models.blend(models.predict_stack(ready.test, stack), weights)
    return _rounded_metrics(models.leaderboard(wide, {n: n for n in [*names, "blended"]}))


@query(
    "scored_requests",
    _KNOWN + """ SELECT row_key, known::DOUBLE AS "Prediction", 'EGP' AS "Currency",
    CASE line_no % 4 WHEN 0 THEN 'Fair Price' WHEN 1 THEN 'Great Deal' WHEN 2 THEN 'Overpriced' ELSE 'Possibly a Scam' END AS verdict FROM y""",
)
def scored_requests(spark, sf_dir):
    """Requests rebuilt from the search table, scored, and judged against the asking price."""
    table = known(spark, sf_dir)
    fitted, _ = train_price_model(table, "row_key", **_ALL)
    view = F.col("view_type")  # garden, sea and unknown
    share = F.when(view == "garden", 1.0).when(view == "sea", 0.8).otherwise(F.when(F.col("line") == 2, 1.2).otherwise(1.6))
    asked = table.withColumn("line", F.split("row_key", "-")[1].cast("int") % 4).withColumn("price_numeric", F.col("price_numeric") * share)
    priced = fitted.score(deals.request_rows(asked), "row_key", "price_numeric")
    return deals.with_verdict(priced, "Prediction").select("row_key", F.round("Prediction", 4).alias("Prediction"), "Currency", "verdict")
