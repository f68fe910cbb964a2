"""The domain tables derived from the given ones, once as DataFrames and once as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairreach.functions.cost import flat_fare
from fairreach.functions.geo import point
from fairreach.operators.cube import summary_cube
from fairreach.operators.reshape import populations
from fairreach.session import checkpoint_root, scratch_path
from fairreach.sources.paged_table import PagedTable

POI_TYPES = ["Hospital", "Job Centre", "Strategic Centre", "School", "Childcare", "Rail Station"]
K_BY_TYPE = {"Hospital": 2, "Job Centre": 2, "Strategic Centre": 1, "School": 3, "Childcare": None, "Rail Station": 2}
GROUPS = {"total": ["flag_a", "flag_n", "flag_r"], "a": ["flag_a"], "n": ["flag_n"], "not_a": ["flag_n", "flag_r"]}
# where the served cube of a folder of tables is stored, by session
_SERVED: dict[tuple[str, str], str] = {}
METRIC_COLUMNS = {"total_time": "total_time", "walk_dist": "walk_dist", "transit_time": "transit_time"}


def lat(key: Column) -> Column:
    return F.lit(52.3) + (key.cast("bigint") * 7919 % 4000) / F.lit(10000.0)


def lon(key: Column) -> Column:
    return F.lit(-2.2) + (key.cast("bigint") * 104729 % 8000) / F.lit(10000.0)


def _sql_lat(key: str) -> str:
    return f"(52.3e0 + (CAST({key} AS BIGINT) * 7919 % 4000) / 10000e0)"


def _sql_lon(key: str) -> str:
    return f"(-2.2e0 + (CAST({key} AS BIGINT) * 104729 % 8000) / 10000e0)"


def _sql_clock(minute: str) -> str:
    return f"lpad(CAST(({minute}) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(({minute}) % 60 AS VARCHAR), 2, '0')"


def clock(minute: Column) -> Column:
    hours = F.lpad(F.floor(minute / 60).cast("string"), 2, "0")
    return F.concat_ws(":", hours, F.lpad((minute % 60).cast("string"), 2, "0"))


class Tables:
    """The parquet tables of one folder as attributes, and the fixtures built on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def fx_oa(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.customer.select(key.alias("oa_id"), lat(key).alias("lat"), lon(key).alias("lon"))

    def fx_poi(self) -> DataFrame:
        key = F.col("s_suppkey")
        kind = F.element_at(F.array([F.lit(t) for t in POI_TYPES]), F.col("s_nationkey") % 6 + 1)
        return self.supplier.select(
            key.alias("poi_id"), kind.alias("type"), F.col("s_name").alias("name"), lat(key).alias("lat"), lon(key).alias("lon")
        )

    def fx_trips(self) -> DataFrame:
        key = F.col("o_orderkey")
        suppliers = self.supplier.agg(F.count("*")).scalar()
        return self.orders.select(
            key.alias("trip_id"),
            F.col("o_custkey").alias("oa_id"),
            (key % suppliers).alias("poi_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            clock(key * 37 % 1440).alias("time"),
            F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("computed"),
        )

    def fx_strata(self) -> DataFrame:
        return self.orders.select(F.col("o_orderkey").alias("trip_id"), F.col("o_orderpriority").alias("stratum"))

    def fx_results(self) -> DataFrame:
        quantity, transfers = F.col("l_quantity"), F.col("l_linenumber") % 4
        timed = self.lineitem.withColumn("total_time", F.floor(F.col("l_extendedprice") / 10).cast("double"))
        walked = timed.withColumn("walk_time", F.when(quantity < 5, F.col("total_time")).otherwise(quantity * 20))
        day = F.date_format("l_shipdate", "yyyy-MM-dd")
        return walked.select(
            F.col("l_orderkey").alias("trip_id"),
            F.concat(day, F.lit(" 08:00:00")).alias("departure_time"),
            F.concat(day, F.lit(" 09:00:00")).alias("arrival_time"),
            "total_time",
            "walk_time",
            (quantity * 3).alias("transfer_wait_time"),
            (quantity * 60).alias("transit_time"),
            (quantity * 25).alias("walk_dist"),
            (quantity * 400).alias("transit_dist"),
            (quantity * 425).alias("total_dist"),
            transfers.alias("num_transfers"),
            (quantity * 30 + 3600).alias("initial_wait_time"),
            flat_fare(transfers, F.col("walk_time"), F.col("total_time")).alias("fare"),
        )

    def fx_cube(self) -> DataFrame:
        return summary_cube(self.fx_results(), self.fx_trips(), self.fx_poi(), self.fx_strata())

    def served_cube(self) -> DataFrame:
        """The cube as served: stored when a session first asks for it, then read from there."""
        from fairreach.plans.serving import CubeStore

        place = _SERVED.setdefault((checkpoint_root(self.spark), self.folder), scratch_path(self.spark, "served-cube"))
        store = CubeStore(self.spark, place)
        if not store.table.version():
            store.refresh(self.fx_results(), self.fx_trips(), self.fx_poi(), self.fx_strata())
        return store.read()

    def paged_trips(self) -> PagedTable:
        """The trips in a stored table of some twenty files."""
        stored = PagedTable(self.spark, scratch_path(self.spark, "paged-trips"), "trip_id")
        stored.write(self.fx_trips(), max(1, self.orders.count() // 20))
        return stored

    def fx_wide(self) -> DataFrame:
        """Counts of order lines per area and return flag; a flag that never occurs stays NULL."""
        # lines of an order need not lie together: counting them by order would widen what is shuffled, not shorten it
        flags = self.lineitem.select("l_orderkey", "l_returnflag")
        joined = self.orders.select("o_orderkey", "o_custkey").join(flags, F.col("o_orderkey") == F.col("l_orderkey"))
        sums = [F.nullif(F.count_if(F.col("l_returnflag") == f), F.lit(0)).alias(f"flag_{f.lower()}") for f in "ANR"]
        return joined.groupBy(F.col("o_custkey").alias("oa11")).agg(*sums)

    def fx_pop(self) -> DataFrame:
        return populations(self.fx_wide(), GROUPS)

    def fx_points(self) -> DataFrame:
        x, y = (F.col("embedding")[i].cast("double") for i in (0, 1))
        return self.embeddings.select(F.col("vec_id").alias("point_id"), x.alias("x"), y.alias("y"))

    def fx_roads(self) -> DataFrame:
        v = [F.col("embedding")[i].cast("double") for i in range(2, 8)]
        way = F.array(point(v[0], v[1]), point(v[2], v[3]), point(v[4], v[5]))
        return self.embeddings.select(F.col("vec_id").alias("line_id"), way.alias("way"))

    def fx_polys(self) -> DataFrame:
        """One triangle per supplier, off the lattice the points lie on."""
        key = F.col("s_suppkey")
        x, y = lon(key) + F.lit(0.00003), lat(key) + F.lit(0.00007)
        h = F.lit(0.01) + (key % 7) * F.lit(0.01)
        ring = F.array(point(x - h, y - h), point(x + h, y - h / 2), point(x, y + h))
        return self.supplier.select(key.alias("poly_id"), F.array(F.array(ring)).alias("geometry"))

    def fx_k_poi(self) -> DataFrame:
        """Each area with the destinations its trips go to."""
        poi = self.fx_poi().select("poi_id", F.col("type").alias("poi_type"))
        return self.fx_trips().select("oa_id", "poi_id").distinct().join(poi, "poi_id").select("oa_id", "poi_id", "poi_type")

    def fx_all_stamps(self) -> DataFrame:
        """Every date and time at which a stratum has a trip."""
        return self.fx_trips().join(self.fx_strata(), "trip_id").select("stratum", "date", "time").distinct()

    def fx_long(self) -> DataFrame:
        from fairreach.operators.reshape import to_long

        return to_long(self.fx_results(), METRIC_COLUMNS)

    def fx_full(self) -> DataFrame:
        """Long results with their dimensions, the stratum taken from the trip."""
        poi = self.fx_poi().select("poi_id", F.col("type").alias("poi_type"))
        trips = self.fx_trips().select("trip_id", "oa_id", "poi_id").join(self.fx_strata(), "trip_id")
        return self.fx_long().join(trips, "trip_id").join(poi, "poi_id")


_TYPE_LIST = ", ".join(f"'{t}'" for t in POI_TYPES)
_MOMENTS = ", ".join(
    f"sum({c}) AS sum_{m}, sum({c} * {c}) AS sum_of_squared_{m}"
    for m, c in [
        ("journey_time", "total_time"),
        ("walking_distance", "walk_dist"),
        ("fare", "fare"),
        ("generalised_cost", "generalised_cost"),
    ]
)

FIXTURE_SQL = {
    "fx_oa": f"SELECT c_custkey AS oa_id, {_sql_lat('c_custkey')} AS lat, {_sql_lon('c_custkey')} AS lon FROM customer",
    "fx_poi": f"""SELECT s_suppkey AS poi_id, ([{_TYPE_LIST}])[s_nationkey % 6 + 1] AS type, s_name AS name,
        {_sql_lat('s_suppkey')} AS lat, {_sql_lon('s_suppkey')} AS lon FROM supplier""",
    "fx_trips": f"""SELECT o_orderkey AS trip_id, o_custkey AS oa_id,
        o_orderkey % (SELECT count(*) FROM supplier) AS poi_id, strftime(o_orderdate, '%Y-%m-%d') AS date,
        {_sql_clock('o_orderkey * 37 % 1440')} AS time,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS computed FROM orders""",
    "fx_strata": "SELECT o_orderkey AS trip_id, o_orderpriority AS stratum FROM orders",
    "fx_timed": """SELECT *, floor(l_extendedprice / 10e0) AS total_time,
        CASE WHEN l_quantity < 5 THEN floor(l_extendedprice / 10e0) ELSE l_quantity * 20 END AS walk_time FROM lineitem""",
    "fx_results": """SELECT l_orderkey AS trip_id, strftime(l_shipdate, '%Y-%m-%d') || ' 08:00:00' AS departure_time,
        strftime(l_shipdate, '%Y-%m-%d') || ' 09:00:00' AS arrival_time, total_time, walk_time,
        l_quantity * 3 AS transfer_wait_time, l_quantity * 60 AS transit_time, l_quantity * 25 AS walk_dist,
        l_quantity * 400 AS transit_dist, l_quantity * 425 AS total_dist, l_linenumber % 4 AS num_transfers,
        l_quantity * 30 + 3600 AS initial_wait_time,
        CASE WHEN walk_time = total_time THEN 0e0 ELSE 2.4e0 * (l_linenumber % 4 + 1) END AS fare FROM fx_timed""",
    "fx_costed": """SELECT *, (1.5e0 * (total_time + (initial_wait_time - 3600)) - 0.5e0 * transit_time
        + fare * 3600 / 6.7e0 + 10 * num_transfers) / 60 AS generalised_cost FROM fx_results""",
    "fx_labelled": """SELECT a.*, b.oa_id, b.poi_id, c.type AS poi_type, d.stratum FROM fx_costed a
        LEFT JOIN fx_trips b ON a.trip_id = b.trip_id LEFT JOIN fx_poi c ON b.poi_id = c.poi_id
        LEFT JOIN fx_strata d ON a.trip_id = d.trip_id""",
    "fx_cube": f"SELECT oa_id, poi_type, stratum, count(*) AS num_trips, {_MOMENTS} FROM fx_labelled GROUP BY 1, 2, 3",
    "fx_wide": """SELECT o_custkey AS oa11, nullif(count(*) FILTER (WHERE l_returnflag = 'A'), 0) AS flag_a,
        nullif(count(*) FILTER (WHERE l_returnflag = 'N'), 0) AS flag_n,
        nullif(count(*) FILTER (WHERE l_returnflag = 'R'), 0) AS flag_r
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
    "fx_pop": """SELECT oa11 AS oa_id, 'total' AS population, coalesce(flag_a, 0) + coalesce(flag_n, 0) + coalesce(flag_r, 0) AS count FROM fx_wide
        UNION ALL SELECT oa11, 'a', coalesce(flag_a, 0) FROM fx_wide
        UNION ALL SELECT oa11, 'n', coalesce(flag_n, 0) FROM fx_wide
        UNION ALL SELECT oa11, 'not_a', coalesce(flag_n, 0) + coalesce(flag_r, 0) FROM fx_wide""",
    "fx_access": "SELECT oa_id, sum(sum_generalised_cost) / sum(num_trips) AS metric FROM fx_cube GROUP BY 1",
    "fx_points": """SELECT vec_id AS point_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y
        FROM embeddings""",
    "fx_segments": """SELECT vec_id AS line_id, 0 AS seg, CAST(embedding[3] AS DOUBLE) AS ax, CAST(embedding[4] AS DOUBLE) AS ay,
        CAST(embedding[5] AS DOUBLE) AS zx, CAST(embedding[6] AS DOUBLE) AS zy FROM embeddings
        UNION ALL SELECT vec_id, 1, CAST(embedding[5] AS DOUBLE), CAST(embedding[6] AS DOUBLE),
        CAST(embedding[7] AS DOUBLE), CAST(embedding[8] AS DOUBLE) FROM embeddings""",
    "fx_tri0": f"""SELECT s_suppkey AS poly_id, {_sql_lon('s_suppkey')} + 0.00003e0 AS cx,
        {_sql_lat('s_suppkey')} + 0.00007e0 AS cy, 0.01e0 + (s_suppkey % 7) * 0.01e0 AS h FROM supplier""",
    "fx_tri": """SELECT poly_id, cx - h AS x1, cy - h AS y1, cx + h AS x2, cy - h / 2 AS y2, cx AS x3, cy + h AS y3
        FROM fx_tri0""",
    "fx_k_poi": """SELECT DISTINCT t.oa_id, t.poi_id, p.type AS poi_type FROM fx_trips t JOIN fx_poi p ON t.poi_id = p.poi_id""",
    "fx_all_stamps": "SELECT DISTINCT stratum, date, time FROM fx_trips JOIN fx_strata USING (trip_id)",
    "fx_long": """SELECT trip_id, 'total_time' AS metric, total_time AS value FROM fx_results
        UNION ALL SELECT trip_id, 'walk_dist', walk_dist FROM fx_results
        UNION ALL SELECT trip_id, 'transit_time', transit_time FROM fx_results""",
    "fx_full": """SELECT l.trip_id, l.metric, l.value, t.oa_id, t.poi_id, p.type AS poi_type, s.stratum FROM fx_long l
        JOIN fx_trips t ON l.trip_id = t.trip_id JOIN fx_poi p ON t.poi_id = p.poi_id
        JOIN fx_strata s ON l.trip_id = s.trip_id""",
}
