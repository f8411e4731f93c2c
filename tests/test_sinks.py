"""Sink round trips."""

import glob
import os

import pytest

from hitlens.operators.charts import top_artists
from hitlens.sinks import write_csv, write_extended_ranking, write_table, write_tuples
from hitlens.sources import read_extended_ranking


def test_tuples_are_ordered_and_refuse_existing_path(spark, scratch):
    df = spark.createDataFrame(
        [("1", "S", f"A{i % 7}", str(i), "u", "d", "cl") for i in range(100)],
        "position string, track string, artist string, streams string, url string, date string, region string",
    )
    report = top_artists(df, "cl")
    out = os.path.join(scratch, "report")
    write_tuples(report, out, "streams", "artist")
    lines = [ln.rstrip("\n") for f in sorted(glob.glob(out + "/part-*")) for ln in open(f)]
    assert lines == [f"({r.streams},{r.artist})" for r in report.collect()]
    assert lines[0] == "(750,A1)"
    with pytest.raises(Exception):
        write_tuples(report, out, "streams", "artist")


def test_csv_round_trip(spark, scratch):
    cols = ["position", "track", "artist", "streams", "url", "date", "region", "country", "begin_area"]
    data = [("1", 'Say "hi" now', " A ", "5", "u", "d", "cl", "", "NONE"), ("2", '"', "", " ", "\t", "d", "cl", "x  ", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "ord int, " + ", ".join(f"{c} string" for c in cols))
    out = os.path.join(scratch, "ext")
    write_extended_ranking(df, out)
    back = read_extended_ranking(spark, out).orderBy("ord").select(*cols).collect()
    assert [tuple(r) for r in back] == data


def test_parquet_partitioned(spark, scratch):
    df = spark.createDataFrame([("a", "cl"), ("b", "ar")], "artist string, region string")
    out = os.path.join(scratch, "t")
    write_table(df, out, partition_by=["region"])
    assert {"_SUCCESS", "region=ar", "region=cl"} <= set(os.listdir(out))
    assert spark.read.parquet(out).where("region = 'cl'").first().artist == "a"


def test_enriched_csv_keeps_input_order_and_strips(spark, scratch):
    from hitlens.operators.enrich import enrich_ranking
    from hitlens.sources import read_extension, read_ranking

    header = "Position,Track Name,Artist,Streams,URL,Date,Region\n"
    lines = [f'{i},"T{i}, x",A,{i},u,d,cl\n' for i in range(40)]
    src = os.path.join(scratch, "rank.csv")
    with open(src, "w") as f:
        f.write(header + "".join(lines))
    ext = os.path.join(scratch, "ext.csv")
    with open(ext, "w") as f:
        f.write("artist,song,r,country,place\n\nA,T1,,CL,P\n")
    out = os.path.join(scratch, "extended")
    enriched = enrich_ranking(read_ranking(spark, src), read_extension(spark, ext))
    cols = ["position", "track", "artist", "streams", "url", "date", "region", "country", "begin_area"]
    write_csv(enriched, out, columns=cols, order_by="ord", strip=True)
    written = [ln for f in sorted(glob.glob(out + "/part-*")) for ln in open(f).read().splitlines()[1:]]
    assert [w.split(",")[0] for w in written] == [str(i) for i in range(40)]
    assert written[1] == "1,T1 x,A,1,u,d,cl,NONE,NONE"
    assert written[10] == "10,T10 x,A,10,u,d,cl,NONE,NONE"


def test_named_writers_use_original_headers(spark, scratch):
    from hitlens.operators.enrich import enrich_ranking
    from hitlens.sinks import write_extended_ranking, write_resolved
    from hitlens.sources import read_extension, read_ranking

    src = os.path.join(scratch, "rank.csv")
    with open(src, "w") as f:
        f.write("Position,Track Name,Artist,Streams,URL,Date,Region\n2,B,A,5,u,d,cl\n1,\"S, x\",A,7,u,d,cl\n")
    ext = os.path.join(scratch, "ext.csv")
    with open(ext, "w") as f:
        f.write("artist,song,result_artist,country,starting_place\n\nA,\"S, x (live)\",,CL,Lima\n")
    out = os.path.join(scratch, "extended")
    write_extended_ranking(enrich_ranking(read_ranking(spark, src), read_extension(spark, ext)), out)
    text = "".join(open(f).read() for f in sorted(glob.glob(out + "/*/part-*")))
    assert text.splitlines() == [
        "Position,Track Name,Artist,Streams,URL,Date,Region,Country,Begin_area",
        "2,B,A,5,u,d,cl,NONE,NONE",
        "1,S x,A,7,u,d,cl,CL,Lima",
    ]
    resolved = spark.createDataFrame([("A, B", "S", "A B", "CL", "x, y")],
                                     "artist string, song string, result_artist string, country string, starting_place string")
    out2 = os.path.join(scratch, "resolved")
    write_resolved(resolved, out2)
    files = [open(f).read().splitlines() for f in sorted(glob.glob(out2 + "/part-*"))]
    assert {f[0] for f in files if f} == {"artist,song,result_artist,country,starting_place"}
    assert [ln for f in files for ln in f[1:]] == ["A B,S,A B,CL,x y"]


def test_ranking_table_splits_a_hot_region(spark, scratch):
    from pyspark.sql import functions as F

    from hitlens.sinks import write_ranking_table

    rows = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("region"),
        F.format_string("2017-01-%02d", (F.col("id") % 28 + 1).cast("int")).alias("date"),
        F.col("id").cast("string").alias("streams"),
    )
    out = os.path.join(scratch, "ranking")
    write_ranking_table(rows, out, files=4)
    hot_files = glob.glob(os.path.join(out, "region=hot", "*.parquet"))
    assert len(hot_files) >= 3  # the region with 90% of the rows is written by several tasks
    back = spark.read.parquet(out)
    assert back.count() == 4000 and back.where("region = 'cold'").count() == 400


def in_small_splits(spark, scratch, n=3000):
    """A ranking of several files in many splits, with its rows in order."""
    rows = []
    for i, name in enumerate(["z.csv", "part-00010.csv", "part-2.csv", "a b.csv"]):
        body = [f'{j},"T{j % 50}, x{i}",A{j % 7},{j},u{i}-{j},d,cl' for j in range(n // (i + 1))]
        with open(os.path.join(scratch, name), "w") as f:
            f.write("Position,Track Name,Artist,Streams,URL,Date,Region\n" + "\n".join(body) + "\n")
        rows.append([f"u{i}-{j}" for j in range(len(body))])
    return [os.path.join(scratch, "z.csv"), scratch + "/part-*", os.path.join(scratch, "a b.csv")], rows[0] + rows[2] + rows[1] + rows[3]


@pytest.mark.parametrize("broadcast", [True, False])
def test_extended_ranking_is_written_in_place(spark, scratch, broadcast):
    from hitlens.operators.enrich import enrich_ranking
    from hitlens.sinks.files import in_place, plan_text
    from hitlens.sources import read_extension, read_ranking

    paths, urls = in_small_splits(spark, scratch)
    ext = os.path.join(scratch, "ext.txt")
    with open(ext, "w") as f:
        f.write("artist,song,result_artist,country,starting_place\n" + "".join(f'A{i % 7},"T{i}, x0",,C{i},P\n' for i in range(50)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if broadcast else "-1")
        enriched = enrich_ranking(read_ranking(spark, paths), read_extension(spark, ext))
        plan = plan_text(in_place(enriched))
        assert ("Exchange hashpartitioning" in plan) != broadcast and "rangepartitioning" not in plan
        out = os.path.join(scratch, "extended")
        write_extended_ranking(enriched, out)
        files = sorted(glob.glob(out + "/*/part-*"))
        assert len(files) > 20
        listed = [ln.split(",") for f in files for ln in open(f).read().splitlines()[1:]]
        assert [x[4] for x in listed] == urls
        assert {x[7] for x in listed} > {"NONE", "C1"}
        back = read_extended_ranking(spark, out).orderBy("ord").collect()
        assert [r.url for r in back] == urls
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_resolved_pairs_keep_the_order_of_the_list(spark, scratch):
    from hitlens.operators.resolve import resolve_pairs
    from hitlens.sinks import write_resolved
    from hitlens.sources import read_delimited, read_pairs
    from tests.test_resolve import AH, WH

    pairs = os.path.join(scratch, "pairs.csv")
    with open(pairs, "w") as f:
        f.write("artist,song\n" + "".join(f"Artist {i * 7 % 900},Song\n" for i in range(900)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        hits = spark.createDataFrame([(f"artist {i}", i, f"Artist {i}, x", "C", "", "P") for i in range(0, 900, 2)], AH)
        found = resolve_pairs(read_pairs(spark, pairs), hits, spark.createDataFrame([], WH))
        out = os.path.join(scratch, "resolved")
        write_resolved(found, out)
        back = read_delimited(spark, out, ("artist", "song", "result_artist", "country", "starting_place")).orderBy("ord").collect()
        assert [r.artist for r in back] == [f"Artist {i * 7 % 900}" for i in range(900)]
        assert back[2].result_artist == "Artist 14 x" and len(glob.glob(out + "/*/part-*")) > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
