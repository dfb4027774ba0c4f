"""Registered queries: each takes (spark, folder of the test tables) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lenstrail.config import CITY_BOX, DATE_FIELDS, ROIS
from lenstrail.functions.columns import from_year, is_known_roi, parse_timestamp
from lenstrail.operators import (
    cells,
    clean,
    clusters,
    density,
    enrich,
    profiles,
    rules,
    sampling,
    summary,
    tags,
    trends,
    views,
)
from lenstrail.plans.stages import raw_json_path, scratch_path, stored, stored_path
from lenstrail.sources import raw_json
from lenstrail.sources.tables import cut_lineage, own_session, read_or_empty, roi_table, spread, standard_names, write_table
from lenstrail.streaming import hourly

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # The tables hold UTC wall-clock times.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return fn


# --- inputs -----------------------------------------------------------------------


def raw_photos(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "raw")


def photos(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "clean")


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "enriched")


def timed(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.time_features(enriched(spark, folder))


def user_table(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.user_profiles(enriched(spark, folder))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return rules.user_transactions(enriched(spark, folder))


def mined_rules(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "rules")


def tiled(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched photos with a reproducible cluster: tiles of a tenth of a degree."""
    row = F.floor((F.col("latitude") - CITY_BOX.lat_min) / 0.1)
    column = F.floor((F.col("longitude") - CITY_BOX.lon_min) / 0.1)
    return enriched(spark, folder).withColumn("cluster", (row * 7 + column).cast("int"))


# --- output shapes ----------------------------------------------------------------


def text_time(column: str) -> Column:
    """Times as text: default dates lie outside what Python timestamps can hold."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def rounded_means(df: DataFrame, *columns: str) -> DataFrame:
    """Means of micro-degrees often end in an exact half; nudge those so all engines agree."""
    return df.withColumns({c: F.round(F.col(c) + 1e-10, 6) for c in columns})


def joined(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


def photo_rows(df: DataFrame, *extra: str) -> DataFrame:
    """Photo table with printable times and a digest of the sorted tags."""
    return df.select(
        "photo_id",
        "user_id",
        "title",
        text_time("timestamp"),
        "latitude",
        "longitude",
        F.size("tags").alias("n_tags"),
        F.md5(F.array_join(F.sort_array("tags"), "|")).alias("tags_md5"),
        *extra,
    )


def rule_rows(df: DataFrame) -> DataFrame:
    shown = joined(df, "antecedent", "consequent")
    return rounded(shown, *[c for c in ("confidence", "lift", "support") if c in df.columns])


# --- sources and cleaning ---------------------------------------------------------


@query
def json_layout(spark, folder):
    files = [raw_json.json_layout(spark, raw_json_path(spark, folder, form)) for form in ("json_lines", "json_array")]
    return files[0].union(files[1]).groupBy("layout").agg(F.sum("records").alias("records"))


@query
def schema_report(spark, folder):
    return raw_json.schema_report(spark, raw_json_path(spark, folder))


def _json_photos(spark: SparkSession, folder: str, form: str) -> DataFrame:
    layout = "json_array" if form == "json_array" else "json_lines"
    records = raw_json.read_photos(spark, raw_json_path(spark, folder, form), layout=layout)
    return photo_rows(clean.clean_photos(records))


@query
def json_clean_photos(spark, folder):
    """Records one a line."""
    return _json_photos(spark, folder, "json_lines")


@query
def json_array_photos(spark, folder):
    """Records as elements of arrays, each on one line."""
    return _json_photos(spark, folder, "json_array")


@query
def json_clean_aliases(spark, folder):
    """Records that spell the date field in three ways."""
    return _json_photos(spark, folder, "json_aliases")


@query
def json_clean_text_coordinates(spark, folder):
    """Records of which every second has its coordinates as text."""
    return _json_photos(spark, folder, "json_text_coordinates")


@query
def alias_resolve(spark, folder):
    """The same photos, with the date under another spelling, and none at all."""
    raw = raw_photos(spark, folder)
    other = raw.withColumnRenamed("dateTaken", DATE_FIELDS[2])
    missing = raw.drop("dateTaken")
    frames = {"other": other, "missing": missing}
    parts = [
        clean.resolve_alias(df, DATE_FIELDS, "taken").agg(
            F.lit(name).alias("case"), F.count("*").alias("records"), F.count("taken").alias("dated")
        )
        for name, df in frames.items()
    ]
    return parts[0].unionAll(parts[1])


@query
def clean_photos(spark, folder):
    return photo_rows(clean.clean_photos(raw_photos(spark, folder)))


@query
def clean_report(spark, folder):
    return rounded(clean.clean_report(raw_photos(spark, folder)), "drop_pct")


@query
def geofence_filter(spark, folder):
    flat = clean.flatten(raw_photos(spark, folder))
    return clean.geofence(flat).select("photo_id", "latitude", "longitude")


@query
def timestamp_parse(spark, folder):
    return raw_photos(spark, folder).select(
        F.col("id").alias("photo_id"), parse_timestamp(F.col("dateTaken")).alias("timestamp")
    ).select("photo_id", text_time("timestamp"))


@query
def clean_report_observed(spark, folder):
    """The report of the pass that writes the clean photos."""
    raw = raw_photos(spark, folder)
    path = stored_path(spark, folder, "raw")
    cleaning = clean.Cleaning(own_session(spark).read.schema(raw.schema).parquet(path))
    write_table(cleaning.photos, scratch_path(spark))
    return rounded(cleaning.report(spark), "drop_pct")


@query
def table_round_trip(spark, folder):
    """Photos through every kind of sink and back: plain, partitioned, replaced, empty, missing."""
    base = scratch_path(spark)
    shown = timed(spark, folder).withColumnRenamed("roi", "roi_name")
    plain = write_table(shown.drop("tags"), f"{base}/plain", max_records_per_file=5000)
    parted = write_table(plain, f"{base}/parted", partition_by=["year"])
    write_table(plain, f"{base}/again")
    again = write_table(plain.where(F.col("roi_name") != "Unknown"), f"{base}/again")
    write_table(plain.limit(0), f"{base}/none", skip_empty=True)
    missing = read_or_empty(spark, f"{base}/none", plain.schema)
    frames = {"plain": plain, "partitioned": parted, "replaced": again, "missing": missing}
    parts = [
        standard_names(df).agg(
            F.lit(name).alias("table"), F.count("*").alias("photos"), F.count_distinct("roi").alias("rois"), F.count_distinct("year").alias("years")
        )
        for name, df in frames.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


# --- regions ----------------------------------------------------------------------


@query
def roi_enrich(spark, folder):
    return enrich.enrich_roi(photos(spark, folder), strategy="case").select("photo_id", "roi")


@query
def roi_enrich_grid(spark, folder):
    return enrich.enrich_roi(photos(spark, folder), strategy="grid").select("photo_id", "roi")


def order_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """A box for every order, somewhere in the city, from some metres to a fifth of a degree wide."""
    key = F.col("o_orderkey")
    orders = spread(spark.read.parquet(f"{folder}/orders.parquet"))
    side = (50 * F.pow(F.lit(2.0), key % 13)).cast("long")
    south, west = 41_600_000 + key * 7919 % 600_000, 12_200_000 + key * 104_729 % 600_000
    return orders.select(
        F.concat(F.lit("o"), key.cast("string")).alias("roi"),
        key.cast("int").alias("priority"),
        (south / 1_000_000.0).alias("lat_min"),
        ((south + side) / 1_000_000.0).alias("lat_max"),
        (west / 1_000_000.0).alias("lon_min"),
        ((west + side * (key % 3 + 1)) / 1_000_000.0).alias("lon_max"),
    )


@query
def enrich_many_boxes(spark, folder):
    return cells.enrich_boxes(photos(spark, folder), order_boxes(spark, folder)).select("photo_id", "roi")


@query
def enrich_many_boxes_shuffled(spark, folder):
    """The same where cells are too many to broadcast and places are busy."""
    boxes = order_boxes(spark, folder)
    return cells.enrich_boxes(photos(spark, folder), boxes, max_broadcast_cells=0, busy=500).select("photo_id", "roi")


@query
def stream_hourly_roi(spark, folder):
    """Photos per region and hour, read as a stream in several micro-batches.

    Photos of all years come in any order, so none may be late; the state is one count an hour and region.
    """
    source = photos(spark, folder)
    files = max(1, len(source.inputFiles()) // 4)
    stream = hourly.photo_stream(spark, stored_path(spark, folder, "clean"), source.schema, files=files)
    out = scratch_path(spark)
    hourly.keep_updates(hourly.hourly_rois(stream, late="1000000 days"), out).awaitTermination()
    return hourly.latest(spark, out).select(text_time("hour"), "roi", "count")


@query
def roi_capture_stats(spark, folder):
    return rounded(enrich.roi_capture_stats(enriched(spark, folder)), "mapped_share")


@query
def roi_centroids(spark, folder):
    """Region centroids with the photos taken in each region."""
    counts = trends.top_rois(enriched(spark, folder))
    dimension = roi_table(spark).select("roi", "priority", "centre_lat", "centre_lon")
    full = dimension.join(counts, "roi", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return rounded(full, "centre_lat", "centre_lon")


# --- descriptive analytics and profiles -------------------------------------------


@query
def top_rois(spark, folder):
    return trends.top_rois(enriched(spark, folder))


@query
def yearly_trend(spark, folder):
    return trends.yearly_trend(photos(spark, folder))


@query
def top_users(spark, folder):
    return trends.top_users(photos(spark, folder))


@query
def time_features(spark, folder):
    return timed(spark, folder).select("photo_id", "hour", "month", "day_of_week", "day_name", "year")


@query
def user_profiles(spark, folder):
    table = user_table(spark, folder).withColumns({c: text_time(c) for c in ("first_seen", "last_seen")})
    return rounded(table, "hour_stddev", "photos_per_day")


@query
def user_relevance_rf(spark, folder):
    return rounded(profiles.user_relevance_model(user_table(spark, folder)), "photos_per_day")


@query
def rf_accuracy(spark, folder):
    return profiles.accuracy(profiles.user_relevance_model(user_table(spark, folder)))


@query
def overview_kpis(spark, folder):
    return trends.overview_kpis(enriched(spark, folder))


@query
def overview_sketch(spark, folder):
    """Users by region from sketches per day, for the real years; `within` tells if the estimate is within 5 %."""
    shown = enriched(spark, folder).filter(from_year(2000))
    sketches = trends.user_sketches(shown)
    estimated = trends.sketched_overview(sketches, "roi").unionByName(trends.sketched_overview(sketches).withColumn("roi", F.lit("all")))
    exact = shown.groupBy("roi").agg(F.count_distinct("user_id").alias("exact"))
    exact = exact.unionByName(shown.agg(F.count_distinct("user_id").alias("exact")).withColumn("roi", F.lit("all")))
    within = F.abs(F.col("users") - F.col("exact")) <= F.col("exact") * 0.05
    return estimated.join(exact, "roi").select("roi", "photos", F.col("exact").alias("users"), within.alias("within"))


@query
def rf_routes(spark, folder):
    """Held-out users routed through the trees as rows; `as_model`: the model predicts the same."""
    model, test = profiles.fit_relevance(user_table(spark, folder))
    routed = profiles.route(test, profiles.forest_nodes(model, scratch_path(spark)))
    both = model.transform(test).join(routed.withColumnRenamed("prediction", "routed"), "user_id")
    return both.select("user_id", "label", (F.col("prediction") == F.col("routed")).alias("as_model"))


@query
def rf_facts(spark, folder):
    """Held-out users of the forest, and whether it is right about more of them than the commoner label is."""
    found = profiles.user_relevance_model(user_table(spark, folder))
    right = F.count_if(F.col("prediction") == F.col("label"))
    common = F.greatest(F.count_if(F.col("label") == 1.0), F.count_if(F.col("label") == 0.0))
    return found.agg(F.count("*").alias("users"), F.count_if(F.col("label") == 1.0).alias("relevant"), (right >= common).alias("better"))


@query
def split_counts(spark, folder):
    """Users in the training and the held-out share."""
    parts = sampling.hash_split(user_table(spark, folder).select("user_id", "total_photos"), "user_id", 0.8)
    rows = [p.agg(F.lit(n).alias("part"), F.count("*").alias("users"), F.sum("total_photos").alias("photos")) for n, p in zip(("train", "test"), parts, strict=True)]
    return rows[0].unionAll(rows[1])


@query
def photo_sample(spark, folder):
    """A fifth of the photos, by the md5 of their ids."""
    return sampling.bernoulli_sample(enriched(spark, folder).select("photo_id", "roi"), 0.2, seed=1, keys=["photo_id"])


@query
def user_segments(spark, folder):
    return rounded(profiles.user_segments(user_table(spark, folder)), "share")


@query
def days_active_hist(spark, folder):
    return profiles.days_active_hist(user_table(spark, folder))


@query
def top_contributors(spark, folder):
    return profiles.top_contributors(user_table(spark, folder))


@query
def user_scatter_sample(spark, folder):
    table = user_table(spark, folder).select("user_id", "days_active", "unique_rois", "user_type", "total_photos")
    return sampling.exact_sample(table, "user_id", 5000)


@query
def user_scatter_cut(spark, folder):
    """A sample smaller than the table of users."""
    table = user_table(spark, folder).select("user_id", "user_type", "total_photos")
    return sampling.exact_sample(table, "user_id", 100)


# --- views ------------------------------------------------------------------------


@query
def hourly_heatmap(spark, folder):
    return views.hourly_heatmap(enriched(spark, folder), user_table(spark, folder))


@query
def od_matrix(spark, folder):
    return views.od_matrix(enriched(spark, folder), user_table(spark, folder))


@query
def od_matrix_gap(spark, folder):
    """Moves between photos at most six hours apart."""
    return views.od_matrix(enriched(spark, folder), user_table(spark, folder), max_gap=6 * 3600)


@query
def user_stays(spark, folder):
    """Stretches of photos without a pause of more than six hours."""
    found = views.stays(enriched(spark, folder), max_gap=6 * 3600)
    return found.select("user_id", text_time("first"), text_time("last"), "photos")


@query
def hidden_gems(spark, folder):
    return rounded(views.hidden_gems(enriched(spark, folder), user_table(spark, folder)), "localness_index")


@query
def peak_hour(spark, folder):
    return views.peak_hour(views.hourly_heatmap(enriched(spark, folder), user_table(spark, folder)))


@query
def peak_hour_total(spark, folder):
    heatmap = views.hourly_heatmap(enriched(spark, folder), user_table(spark, folder))
    return views.peak_hour(heatmap, per="total")


@query
def local_spots(spark, folder):
    gems = views.hidden_gems(enriched(spark, folder), user_table(spark, folder))
    return rounded(views.local_spots(gems), "localness_index")


# --- tags -------------------------------------------------------------------------


@query
def roi_tags(spark, folder):
    return tags.roi_tags(enriched(spark, folder))


@query
def roi_word_weights(spark, folder):
    counts = tags.roi_word_counts(enriched(spark, folder))
    return rounded(tags.roi_word_weights(counts), "share")


# --- rules ------------------------------------------------------------------------


@query
def user_transactions(spark, folder):
    return joined(transactions(spark, folder), "items")


@query
def freq_itemsets(spark, folder):
    return joined(rules.frequent_itemsets(transactions(spark, folder)), "items")


@query
def top_itemsets(spark, folder):
    return joined(rules.top_itemsets(rules.frequent_itemsets(transactions(spark, folder))), "items")


@query
def assoc_rules(spark, folder):
    """Mined here; the queries after this one start from the stored rules."""
    return rule_rows(rules.association_rules(transactions(spark, folder)))


@query
def rules_top_lift(spark, folder):
    return rule_rows(rules.top_rules(mined_rules(spark, folder)))


@query
def rules_filtered(spark, folder):
    return rule_rows(rules.filter_rules(mined_rules(spark, folder)))


@query
def flow_links(spark, folder):
    return rounded(rules.flow_links(mined_rules(spark, folder)), "confidence", "lift", "support")


@query
def flow_nodes(spark, folder):
    return rules.flow_nodes(rules.flow_links(mined_rules(spark, folder)))


@query
def flow_link_indices(spark, folder):
    links = cut_lineage(rules.flow_links(mined_rules(spark, folder)))
    return rules.flow_link_indices(links, rules.flow_nodes(links)).select(
        "source", "target", "source_idx", "target_idx", "thickness"
    )


@query
def start_places(spark, folder):
    return rules.start_places(mined_rules(spark, folder))


@query
def next_step(spark, folder):
    return rounded(rules.next_step(mined_rules(spark, folder)), "prob", "lift")


@query
def next_step_arcs(spark, folder):
    arcs = rules.next_step_arcs(rules.next_step(mined_rules(spark, folder)))
    ends = ("source_lat", "source_lon", "target_lat", "target_lon")
    return rounded(arcs, "prob", "lift", "width", *ends)


# --- density map ------------------------------------------------------------------


@query
def hexbin_density(spark, folder):
    return density.hexbin_density(density.map_points(enriched(spark, folder)))


@query
def roi_centres(spark, folder):
    return rounded_means(density.roi_centres(density.map_points(enriched(spark, folder))), "lat", "lon")


@query
def top_label_centres(spark, folder):
    return rounded_means(density.roi_centres(density.map_points(enriched(spark, folder)), top=50), "lat", "lon")


@query
def view_centre(spark, folder):
    return rounded_means(density.view_centre(density.map_points(enriched(spark, folder))), "lat", "lon")


@query
def map_sample(spark, folder):
    points = density.map_points(enriched(spark, folder)).select("photo_id", "latitude", "longitude", "roi")
    return sampling.exact_sample(points, "photo_id", 4000)


@query
def filtered_map(spark, folder):
    """Photos under the filters of the map, with the user type taken from the profiles."""
    shown = trends.filter_photos(
        timed(spark, folder),
        years=["2023", "2024"],
        months=[1, 6, 12],
        rois=["Colosseo", "Pantheon", "Vaticano"],
    )
    keys = ["roi", "year", "month"]
    per_user = shown.groupBy("user_id", *keys).agg(F.count("*").alias("n"))
    typed = trends.filter_photos(
        views.add_user_type(per_user, user_table(spark, folder)), user_types=["Resident", "Tourist"]
    )
    return typed.groupBy(*keys, "user_type").agg(F.sum("n").alias("count"))


MAP_FILTERS = {"years": ["2023", "2024"], "months": [1, 6, 12], "rois": ["Colosseo", "Pantheon", "Vaticano"]}
TREND_FILTERS = {"years": ["2023", "2024"], "rois": ["Colosseo", "Pantheon", "Vaticano"]}


def filtered_points(spark: SparkSession, folder: str) -> DataFrame:
    shown = density.map_points(trends.filter_photos(timed(spark, folder), **MAP_FILTERS))
    return views.of_user_types(shown, user_table(spark, folder), ["Resident", "Tourist"])


@query
def hexbin_filtered(spark, folder):
    return density.hexbin_density(filtered_points(spark, folder))


@query
def roi_centres_filtered(spark, folder):
    return rounded_means(density.roi_centres(filtered_points(spark, folder)), "lat", "lon")


@query
def view_centre_filtered(spark, folder):
    return rounded_means(density.view_centre(filtered_points(spark, folder)), "lat", "lon")


@query
def map_counts_filtered(spark, folder):
    points = filtered_points(spark, folder).select("photo_id", "latitude", "longitude", "roi")
    return density.map_counts(points, sampling.exact_sample(points, "photo_id", 50))


# --- trends -----------------------------------------------------------------------


@query
def month_roi(spark, folder):
    return trends.month_roi(timed(spark, folder).filter(is_known_roi()))


@query
def hour_roi(spark, folder):
    return trends.hour_roi(timed(spark, folder).filter(is_known_roi()))


@query
def weekday_counts(spark, folder):
    return trends.weekday_counts(timed(spark, folder).filter(is_known_roi()))


@query
def day_hour_grid(spark, folder):
    return trends.day_hour_grid(timed(spark, folder).filter(is_known_roi()))


def filtered_times(spark: SparkSession, folder: str) -> DataFrame:
    return trends.filter_photos(timed(spark, folder), **TREND_FILTERS)


@query
def month_roi_filtered(spark, folder):
    return trends.month_roi(filtered_times(spark, folder))


@query
def hour_roi_filtered(spark, folder):
    return trends.hour_roi(filtered_times(spark, folder))


@query
def weekday_filtered(spark, folder):
    return trends.weekday_counts(filtered_times(spark, folder))


@query
def day_hour_filtered(spark, folder):
    return trends.day_hour_grid(filtered_times(spark, folder))


@query
def filter_values(spark, folder):
    return trends.filter_values(timed(spark, folder).filter(is_known_roi()), ["year", "month", "roi"])


@query
def default_rois(spark, folder):
    return trends.default_rois(enriched(spark, folder))


# --- clusters ---------------------------------------------------------------------


@query
def kmeans_clusters(spark, folder):
    return clusters.kmeans_clusters(enriched(spark, folder)).select("photo_id", "roi", "cluster")


@query
def kmeans_sizes(spark, folder):
    return clusters.cluster_sizes(clusters.kmeans_clusters(enriched(spark, folder)))


@query
def kmeans_silhouette(spark, folder):
    return clusters.silhouette(clusters.kmeans_clusters(enriched(spark, folder)))


@query
def kmeans_facts(spark, folder):
    """Clusters, photos, photos nearer to another centre, and whether centres lie at their members' mean."""
    shown = enriched(spark, folder)
    centres = clusters.fit_centres(shown)
    facts = clusters.centre_facts(clusters.assign_nearest(shown, centres), centres)
    return facts.agg(
        F.count("*").alias("clusters"), F.sum("photos").alias("photos"), F.sum("strays").alias("strays"), (F.max("offset") < 0.01).alias("centred")
    )


@query
def silhouette_facts(spark, folder):
    """The trained clusters' silhouette against the one from sums per cluster."""
    clustered = cut_lineage(clusters.kmeans_clusters(enriched(spark, folder)).select("latitude", "longitude", "cluster"))
    exact, fitted = clusters.exact_silhouette(clustered).scalar(), clusters.silhouette(clustered)
    value = F.col("silhouette")
    return fitted.select((F.abs(value - exact) < 1e-6).alias("as_evaluator"), value.between(-1, 1).alias("in_range"))


@query
def exact_silhouette(spark, folder):
    value = clusters.exact_silhouette(tiled(spark, folder))
    return value.withColumn("silhouette", F.round("silhouette", 4))


@query
def cluster_silhouette(spark, folder):
    """All rows, reproducible clusters."""
    value = clusters.silhouette(tiled(spark, folder), fraction=1)
    return value.withColumn("silhouette", F.round("silhouette", 4))


@query
def cluster_sizes(spark, folder):
    return clusters.cluster_sizes(tiled(spark, folder))


@query
def cluster_centres(spark, folder):
    return rounded_means(clusters.cluster_centres(tiled(spark, folder)), "lat", "lon")


@query
def cluster_focus(spark, folder):
    """One cluster alone."""
    one = trends.filter_photos(tiled(spark, folder), clusters=[16])
    return rounded_means(clusters.cluster_centres(one), "lat", "lon")


@query
def nearest_centre_assign(spark, folder):
    centres = [(i, *roi.centre) for i, roi in enumerate(ROIS)]
    return clusters.assign_nearest(photos(spark, folder), centres).select("photo_id", "cluster")


@query
def cluster_labels(spark, folder):
    return rounded_means(clusters.cluster_labels(tiled(spark, folder)), "lat", "lon")


@query
def cluster_points_sample(spark, folder):
    points = tiled(spark, folder)
    shown = sampling.exact_sample(points.select("photo_id", "latitude", "longitude", "cluster"), "photo_id", 4000)
    return clusters.label_points(shown, clusters.cluster_labels(points))


@query
def cluster_hulls(spark, folder):
    return clusters.cluster_hulls(tiled(spark, folder))


# --- summary ----------------------------------------------------------------------


@query
def exec_summary(spark, folder):
    return rounded(summary.exec_summary(tiled(spark, folder), timed(spark, folder)), "share")
