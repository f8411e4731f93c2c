"""Music-chart shaped tables derived from the generic test tables.

The test data has no chart, extension, request or candidate tables, so these
are derived from ``lineitem``, ``orders``, ``customer``, ``nation``,
``region``, ``part`` and ``supplier`` (see ``FIXTURES.md``). They grow with
the input scale; every join is an equi join, and only ``nation`` and
``region`` (25 and 5 rows by definition) are broadcast by hint.

The DuckDB oracles in :mod:`hitlens.plans.oracles` restate the same
derivations in SQL, independently of this code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlens.functions import normalise_artist
from hitlens.session import Intermediates, parallelism

# Page size of a stored candidate response document (one search result page).
PAGE = 100
# Line items of a task that aggregates the chart, and of a part file of it.
PER_TASK = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chart_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks among which the chart's rows are dealt: they grow with the line items (a count of rows reads no column)."""
    return max(parallelism(spark), table(spark, sf_dir, "lineitem").count() // PER_TASK)


def chart(spark: SparkSession, sf_dir: str, parts: int | None = None, tables: Intermediates | None = None) -> DataFrame:
    """Daily-ranking shaped table: one row per (track, artist, date, region), in ``parts`` partitions.

    With ``tables`` the rows with names are stored there now, so that the shuffles that make them are
    gone from disk before the one that ranks them begins.

    track/artist = part name and number/brand (see ``_track``, ``_artist``), date = first day of the order month
    (text), region = customer nation, streams = total quantity, position =
    rank within (date, region) by streams desc, track, artist.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-01").alias("date")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("region")))
    # Order -> (date, region) first, so lineitem joins a narrow table once.
    order_dim = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .select("o_orderkey", "date", "region")
    )
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", _track().alias("track"), _artist().alias("artist"))
    # Rows with a part's key are narrow, so many would share a task, in which the names make large groups of them.
    sold = lineitem.join(order_dim, lineitem.l_orderkey == order_dim.o_orderkey).select("l_partkey", "l_quantity", "date", "region")
    tasks = chart_tasks(spark, sf_dir)
    by_part = sold.repartition(tasks, "l_partkey").groupBy("l_partkey", "date", "region").agg(F.sum("l_quantity").alias("quantity"))
    named = by_part.join(part, F.col("l_partkey") == part.p_partkey).select("track", "artist", "date", "region", "quantity")
    if tables is not None:
        named = tables.stored(named, "chart-named")
    # A window partition holds the tracks of one month in one nation. Rows with names are wide: they are shuffled once, for the
    # window, and parts of one name meet there too.
    daily = (
        named.repartition(parts or tasks, "date", "region")
        .groupBy("track", "artist", "date", "region")
        .agg(F.sum("quantity").cast("bigint").alias("streams"))
    )
    w = Window.partitionBy("date", "region").orderBy(F.col("streams").desc(), "track", "artist")
    return daily.select(
        F.row_number().over(w).alias("position"),
        "track",
        "artist",
        "streams",
        F.concat(F.lit("https://charts.invalid/"), F.col("region"), F.lit("/"), F.col("date"),
                 F.lit("?t="), F.col("track"), F.lit(","), F.col("artist")).alias("url"),
        "date",
        "region",
    )


def _artist() -> Column:
    """Artist of a part: its brand, for every fifth with a comma."""
    return F.concat("p_brand", F.when(F.col("p_partkey") % 5 == 0, F.lit(", Jr.")).otherwise(F.lit("")))


def _track() -> Column:
    """Track of a part: its name and a number that grows with the parts, for every fourth with a comma."""
    number = F.floor(F.col("p_partkey") / 4).cast("string")
    return F.concat("p_name", F.when(F.col("p_partkey") % 4 == 0, F.lit(", pt. ")).otherwise(F.lit(" ")), number)


def extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origin table (ord, artist, song, country, starting_place): one row per part, and one per order.

    Rows of parts hold the tracks of the chart, some inside longer titles;
    rows of orders hold titles that mostly match nothing, but grow with the
    input. ``country`` null marks a row of at most 3 fields,
    ``starting_place`` null one of at most 4; ``country`` is ``''`` for some.
    """
    part = table(spark, sf_dir, "part")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    short3 = F.col("p_size") % 11 == 0
    short4 = short3 | (F.col("p_size") % 5 == 0)
    return (
        part.join(nation, (F.col("p_partkey") % 25) == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("p_partkey") * 10).alias("ord"),
            _artist().alias("artist"),
            F.concat(_track(), F.when(F.col("p_partkey") % 3 == 0, F.lit(" (live)")).otherwise(F.lit(""))).alias("song"),
            F.when(short3, F.lit(None).cast("string"))
            .when(F.col("p_size") % 7 == 0, F.lit(""))
            .otherwise(F.col("n_name"))
            .alias("country"),
            F.when(short4, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("starting_place"),
        )
        .unionByName(
            table(spark, sf_dir, "orders").select(
                (F.col("o_orderkey") * 10 + 1).alias("ord"),
                F.concat(F.lit("Brand#"), (F.col("o_orderkey") % 60).cast("string"), F.lit(" and friends")).alias("artist"),
                F.concat(F.lit("small red ring "), F.col("o_orderkey").cast("string")).alias("song"),
                F.lit("ORDER").alias("country"),
                F.col("o_orderpriority").alias("starting_place"),
            )
        )
    )


def hot_needles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased (la, lt) needles from ``part``: short prefixes of the artists and songs that orders give the extension."""
    k = F.col("p_partkey")
    number = F.substr(k.cast("string"), F.lit(1), (k % 3).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("brand#"), F.floor(k / 7) % 66).alias("la"), F.concat(F.lit("small red ring "), number).alias("lt")
    ).distinct()


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings table (rating, series, year, type, episode) from ``events``."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("value").alias("rating"),
        F.col("event_type").alias("series"),
        F.col("user_id").cast("string").alias("year"),
        F.when(F.col("event_type") == "purchase", F.lit("TV_SERIES")).otherwise(F.col("event_type")).alias("type"),
        F.when(F.col("props") == '{"k": 69}', F.lit("null")).otherwise(F.col("props")).alias("episode"),
    )


def padded_lines(texts: DataFrame) -> DataFrame:
    """Lines of the texts, with double spaces after commas and up to two spaces at the end."""
    from hitlens.operators.groups import lines_of

    pad = F.repeat(F.lit(" "), (F.length("value") % 3).cast("int"))
    return lines_of(texts).select(F.concat(F.replace("value", F.lit(", "), F.lit(",  ")), pad).alias("value"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


# ---------------------------------------------------------------- resolution


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    k = F.col("s_suppkey")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k,
            "s_name",
            F.concat(F.col("s_name"), F.lit(" & "), F.repeat(F.lit("x"), (k % 4).cast("int"))).alias("nm"),
            F.when(k % 9 == 0, F.lit("")).otherwise(F.col("n_name")).alias("country"),
            F.when(k % 5 == 0, F.lit("")).otherwise(F.col("r_name")).alias("begin_area"),
            F.substr(F.col("s_name"), F.lit(1), F.lit(17)).alias("prefix"),
            # Some artists have no id; they join works without one.
            F.when(k % 13 == 0, F.lit("")).otherwise(k.cast("string")).alias("arid"),
        )
    )


def _noun(name: F.Column) -> F.Column:
    return F.get(F.split(name, " ", -1), 1)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(artist, song) pairs to resolve.

    (a) every supplier-name prefix (17 chars; lower-cased for odd groups of
        ten suppliers) with the noun of every part its group supplies, and
        with ``zzz`` (no work: artist-only fallback);
    (b) the lower-cased ``&`` name of every supplier with ``ring`` and
        ``zzz`` (names with an ``x`` suffix match only through the raw name);
    (c) ``Nobody & <region>`` with ``ring`` (no candidate at all).
    """
    sup = _suppliers(spark, sf_dir)
    pfx = F.when((F.col("s_suppkey") % 20) < 10, F.col("prefix")).otherwise(F.lower("prefix")).alias("artist")
    lineitem = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    supplied = (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .select("l_suppkey", _noun(F.col("p_name")).alias("song"))
        .distinct()
    )
    a_songs = (
        sup.join(supplied, sup.s_suppkey == supplied.l_suppkey)
        .select(pfx, "song")
    )
    a_zzz = sup.select(pfx, F.lit("zzz").alias("song"))
    raw = sup
    b_ring = raw.select(F.lower("nm").alias("artist"), F.lit("ring").alias("song"))
    b_zzz = raw.select(F.lower("nm").alias("artist"), F.lit("zzz").alias("song"))
    c = table(spark, sf_dir, "region").select(
        F.concat(F.lit("Nobody & "), F.col("r_name")).alias("artist"), F.lit("ring").alias("song")
    )
    return a_songs.unionByName(a_zzz).unionByName(b_ring).unionByName(b_zzz).unionByName(c).distinct()


def artist_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate artists per normalised-name query: (query, ord, name, country, arid, begin_area).

    Each supplier is a hit for its lower-cased prefix, a decoy hit for the
    next group's prefix (fails the name test), and a hit for its normalised
    ``&`` name.
    """
    sup = _suppliers(spark, sf_dir)
    cols = [F.col("s_suppkey").alias("ord"), F.col("nm").alias("name"), "country",
            "arid", "begin_area"]
    own = sup.select(F.lower("prefix").alias("query"), *cols)
    nxt = F.concat(F.lit("supplier#"), F.lpad((F.floor(F.col("s_suppkey") / 10) + 1).cast("string"), 8, "0"))
    decoy = sup.select(nxt.alias("query"), *cols)
    normed = sup.select(normalise_artist("nm").alias("query"), *cols)
    return own.unionByName(decoy).unionByName(normed)


def work_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate works per lower-cased song query: (query, ord, item, arid, name, title).

    Distinct (supplier, part name) supplied pairs; query = the noun of the
    name; order = (ord, title). Works of suppliers with key % 7 = 0 have a
    second artist, without an id.
    """
    lineitem = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pairs = lineitem.join(part, lineitem.l_partkey == part.p_partkey).select("l_suppkey", "p_name").distinct()
    work = pairs.select(_noun(F.col("p_name")).alias("query"), F.col("l_suppkey").alias("ord"), F.col("p_name").alias("title"))
    key = F.col("ord").cast("string")
    first = work.select("query", "ord", F.lit(0).alias("item"), key.alias("arid"), F.concat(F.lit("Artist "), key).alias("name"), "title")
    second = work.where(F.col("ord") % 7 == 0).select(
        "query", "ord", F.lit(1).alias("item"), F.lit("").alias("arid"), F.lit("Anon").alias("name"), "title")
    return first.unionByName(second)


def chart_artist_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate artists for the chart's own artists (part brands).

    Supplier k is a candidate, named ``Brand#<k % 25 + 1> & <s_name>``, for
    the query of that brand, and one named with ``, Jr.`` for that query.
    """
    sup = _suppliers(spark, sf_dir)
    sup = sup.withColumn("suffix", F.explode(F.array(F.lit(""), F.lit(", Jr."))))
    brand = F.concat(F.lit("Brand#"), ((F.col("s_suppkey") % 25) + 1).cast("string"), F.col("suffix"))
    return sup.select(
        F.lower(brand).alias("query"),
        F.col("s_suppkey").alias("ord"),
        F.concat(brand, F.lit(" & "), F.col("s_name")).alias("name"),
        "country",
        "arid",
        "begin_area",
    )


def chart_work_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate works for the chart's own songs: every supplied (supplier, part) pair."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", _track().alias("track"))
    pairs = lineitem.join(part, lineitem.l_partkey == part.p_partkey).select("l_suppkey", "track").distinct()
    return pairs.select(
        F.lower("track").alias("query"),
        F.col("l_suppkey").alias("ord"),
        F.col("l_suppkey").cast("string").alias("arid"),
        F.concat(F.lit("Artist "), F.col("l_suppkey").cast("string")).alias("name"),
        F.col("track").alias("title"),
    )


def _xml_text(c: F.Column) -> F.Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _element(tag: str, c: F.Column) -> F.Column:
    """``<tag>text</tag>``, or nothing when the value is empty (absent attribute)."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit(f"<{tag}>"), _xml_text(c), F.lit(f"</{tag}>"))
    )


def _pages(items: DataFrame, order: list[str], root: str, list_tag: str) -> DataFrame:
    """Group item fragments into response pages of ``PAGE`` ordinals each.

    ``collect_list`` is bounded by the items of those ordinals (up to eight
    hundred works): no query's whole hit list is ever gathered in one row.
    """
    grouped = items.groupBy("query", (F.col("ord") / PAGE).cast("bigint").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order], F.col("xml")))).alias("items")
    )
    body = F.array_join(F.transform("items", lambda x: x["xml"]), "")
    # Pages are few but large and parsing is costly per byte: keep one
    # partition per task slot instead of letting AQE merge them by size.
    return grouped.repartition(parallelism(items.sparkSession), "query", "page").select(
        "query", "page",
        F.concat(F.lit(f"<{root}><{list_tag} count=\""), F.size("items").cast("string"), F.lit("\">"),
                 body, F.lit(f"</{list_tag}></{root}>")).alias("doc"),
    )


def artist_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored artist-search response pages: (query, page, doc) XML."""
    hits = artist_hits(spark, sf_dir)
    xml = F.concat(
        F.lit("<artist"), F.when(F.col("arid") == "", F.lit("")).otherwise(F.concat(F.lit(' id="'), _xml_text(F.col("arid")), F.lit('"'))), F.lit(">"),
        _element("name", F.col("name")), _element("country", F.col("country")),
        F.when(F.col("begin_area") == "", F.lit("")).otherwise(
            F.concat(F.lit("<begin-area>"), _element("name", F.col("begin_area")), F.lit("</begin-area>"))),
        F.lit("</artist>"),
    )
    return _pages(hits.select("query", "ord", xml.alias("xml")), ["ord"], "metadata", "artist-list")


def work_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored work-search response pages: (query, page, doc) XML.

    Works of suppliers with key % 3 = 0 also carry a non-artist relation
    list, which flattening must skip, and those with key % 5 = 0 an empty
    artist relation list and an empty relation, which must hide nothing.
    Titles of those with key % 4 = 1 are padded.
    """
    hits = work_hits(spark, sf_dir).where("item = 0")
    artist_rel = F.concat(
        F.lit('<relation-list target-type="artist"><relation type="composer"><artist id="'),
        _xml_text(F.col("arid")), F.lit('">'), _element("name", F.col("name")),
        F.lit("</artist></relation></relation-list>"),
    )
    other_rel = F.when(F.col("ord") % 3 == 0, F.lit(
        '<relation-list target-type="label"><relation type="publishing"><artist id="0"><name>Label</name>'
        "</artist></relation></relation-list>")).otherwise(F.lit(""))
    empty_rel = F.when(F.col("ord") % 5 == 0, F.lit(
        '<relation-list target-type="artist"/><relation-list target-type="artist"><relation/></relation-list>')).otherwise(F.lit(""))
    second_rel = F.when(F.col("ord") % 7 == 0, F.lit(
        '<relation-list target-type="artist"><relation type="lyricist"><artist><name>Anon</name></artist></relation>'
        "</relation-list>")).otherwise(F.lit(""))
    title = F.when(F.col("ord") % 4 == 1, F.concat(F.lit("\n  "), F.col("title"), F.lit(" \t"))).otherwise(F.col("title"))
    xml = F.concat(F.lit("<work>"), _element("title", title), empty_rel, other_rel, artist_rel, second_rel, F.lit("</work>"))
    return _pages(hits.select("query", "ord", "title", xml.alias("xml")), ["ord", "title"], "metadata", "work-list")


class Tables:
    """Lazily derived inputs of the registered queries."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def chart(self, tables: Intermediates | None = None) -> DataFrame:
        return chart(self.spark, self.sf_dir, tables=tables)

    def parts(self) -> int:
        return max(5, table(self.spark, self.sf_dir, "lineitem").count() // PER_TASK)

    def chart_parts(self, tables: Intermediates | None = None) -> DataFrame:
        """The chart in five parts at least, more as it grows: those of its window, so that no finished row is shuffled."""
        return chart(self.spark, self.sf_dir, self.parts(), tables)

    def extension(self) -> DataFrame:
        return extension(self.spark, self.sf_dir)

    def hot_needles(self) -> DataFrame:
        return hot_needles(self.spark, self.sf_dir)

    def series(self) -> DataFrame:
        return series(self.spark, self.sf_dir)

    def texts(self) -> DataFrame:
        return texts(self.spark, self.sf_dir)

    def odd_rows(self) -> DataFrame:
        """Nine text columns with padded, quoted and empty fields, and their order."""
        key = F.col("p_partkey")
        some = lambda n, value: F.when(key % n == 0, F.lit("")).otherwise(value)
        return table(self.spark, self.sf_dir, "part").select(
            key.alias("ord"), key.cast("string").alias("position"), F.concat(F.lit(' "'), "p_name", F.lit('",  ')).alias("track"),
            some(3, F.concat("p_brand", F.lit("  "))).alias("artist"), F.col("p_size").cast("string").alias("streams"),
            some(2, F.lit(" ")).alias("url"), F.lit('a""b').alias("date"), F.lit('"').alias("region"),
            F.col("p_type").alias("country"), some(5, F.lit(" x")).alias("begin_area"))

    def ragged_lines(self) -> DataFrame:
        """Lines of one to three fields, with quotes around and inside them, and blank lines."""
        name, brand = F.col("p_name"), F.col("p_brand")
        kinds = [F.concat(name, F.lit(","), brand), name, F.concat(F.lit('"'), name, F.lit(', ""x""",'), brand, F.lit(",")),
                 F.concat(name, F.lit('" mix,')), F.lit("")]
        return table(self.spark, self.sf_dir, "part").select(F.element_at(F.array(*kinds), (F.col("p_partkey") % 5 + 1).cast("int")).alias("value"))

    def requests(self) -> DataFrame:
        return requests(self.spark, self.sf_dir)

    def artist_documents(self) -> DataFrame:
        return artist_documents(self.spark, self.sf_dir)

    def work_documents(self) -> DataFrame:
        return work_documents(self.spark, self.sf_dir)

    def chart_artist_hits(self) -> DataFrame:
        return chart_artist_hits(self.spark, self.sf_dir)

    def chart_work_hits(self) -> DataFrame:
        return chart_work_hits(self.spark, self.sf_dir)

    def artist_candidates(self) -> DataFrame:
        """Flattened artist pages (parsed once, then read by resolution)."""
        from hitlens.operators.candidates import flatten_artists

        return flatten_artists(self.artist_documents())

    def work_candidates(self) -> DataFrame:
        from hitlens.operators.candidates import flatten_works

        return flatten_works(self.work_documents())


STORED = ("chart", "extension", "series", "requests", "artist_documents", "work_documents",
          "artist_candidates", "work_candidates", "chart_artist_hits", "chart_work_hits")


class StoredTables(Tables):
    """Derived tables written once as Parquet and read back (the jobs' stored inputs)."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        super().__init__(spark, sf_dir)
        self.root = root

    @classmethod
    def materialize(cls, spark: SparkSession, sf_dir: str, root: str) -> "StoredTables":
        """Write the derived inputs as a production job would store them.

        The ranking gets the report layout of ``write_ranking_table``
        (partitioned by region, sorted by date).
        """
        from hitlens.sinks import write_ranking_table

        derived = Tables(spark, sf_dir)
        for name in STORED:
            df = getattr(derived, name)()
            if name == "chart":
                write_ranking_table(df, f"{root}/{name}", mode="overwrite")
            else:
                df.write.mode("overwrite").parquet(f"{root}/{name}")
        return cls(spark, sf_dir, root)

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def texts(self) -> DataFrame:
        return texts(self.spark, self.sf_dir)

    def chart(self, tables: Intermediates | None = None) -> DataFrame:
        return self._stored("chart")

    def chart_parts(self, tables: Intermediates | None = None) -> DataFrame:
        return self.chart().repartition(self.parts())

    def extension(self) -> DataFrame:
        return self._stored("extension")

    def series(self) -> DataFrame:
        return self._stored("series")

    def requests(self) -> DataFrame:
        return self._stored("requests")

    def artist_documents(self) -> DataFrame:
        return self._stored("artist_documents")

    def work_documents(self) -> DataFrame:
        return self._stored("work_documents")

    def chart_artist_hits(self) -> DataFrame:
        return self._stored("chart_artist_hits")

    def chart_work_hits(self) -> DataFrame:
        return self._stored("chart_work_hits")

    def artist_candidates(self) -> DataFrame:
        return self._stored("artist_candidates")

    def work_candidates(self) -> DataFrame:
        return self._stored("work_candidates")
