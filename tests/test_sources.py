"""File sources: quoting, ragged widths, leading lines, file order, TSV rules."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from hitlens.sources import read_delimited, read_extension, read_lines, read_pairs, read_ranking, read_series
from hitlens.sources.delimited import raw_lines, parse_delimited


def write(directory, name, text):
    path = os.path.join(directory, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_quoted_fields_and_widths(spark, scratch):
    p = write(scratch, "e.csv", 'h\nx,y,z,,\nx,y,z\nx,y,z,\nx,"q,r",z,CL\n"A, ""b""",2\n')
    df = parse_delimited(raw_lines(spark, p), ["a", "b", "c", "d", "e"])
    got = [(r.a, r.b, r.c, r.d, r.e, r.width) for r in df.orderBy("ord").collect()]
    assert got[1:] == [
        ("x", "y", "z", "", "", 5),
        ("x", "y", "z", None, None, 3),
        ("x", "y", "z", "", None, 4),
        ("x", "q,r", "z", "CL", None, 4),
        ('A, "b"', "2", None, None, None, 2),
    ]


def test_only_header_and_blank_lines_are_dropped(spark, scratch):
    head = "artist,song,result_artist,country,starting_place\n"
    p = write(scratch, "ext.csv", head + "\nA,S,R,CL,P\n\nB,T,R,AR\nC,U\n")
    got = [(r.artist, r.song, r.country, r.starting_place) for r in read_extension(spark, p).orderBy("ord").collect()]
    assert got == [("A", "S", "CL", "P"), ("B", "T", "AR", None), ("C", "U", None, None)]
    p2 = write(scratch, "ext2.csv", head + "FIRST,S,R,CL,P\nA,S,R,CL,P\n")
    p3 = write(scratch, "ext3.csv", "ZERO,S,R,CL,P\nA,S,R,CL,P\n")
    assert [r.artist for r in read_extension(spark, [p2, p3]).orderBy("ord").collect()] == ["FIRST", "A", "ZERO", "A"]


def test_headerless_part_files_lose_no_row(spark, scratch):
    for i in range(3):
        write(scratch, f"part-{i}", "".join(f"{j},T{i}{j},A,{j},u,2017-01-01,cl\n" for j in range(5)))
    assert read_ranking(spark, scratch).count() == 15


def test_paths_count_as_given_and_parts_by_number(spark, scratch):
    b, a = write(scratch, "b.csv", "b,1\n"), write(scratch, "a.csv", "a,1\n")
    assert [r.artist for r in read_pairs(spark, [b, a]).orderBy("ord").collect()] == ["b", "a"]
    parts = os.path.join(scratch, "parts")
    os.makedirs(parts)
    for n in (100000, 99999, 5):
        write(parts, f"part-{n}", f"p{n},s\n")
    assert [r.artist for r in read_pairs(spark, parts).orderBy("ord").collect()] == ["p5", "p99999", "p100000"]


def test_quotes_inside_fields_and_open_quotes(spark, scratch):
    line = '1,12" Mix,The "X" Band,10,u,2017-01-01,cl\n'
    r = read_ranking(spark, write(scratch, "q.csv", line)).first()
    assert (r.track, r.artist, r.region) == ('12" Mix', 'The "X" Band', "cl")
    broken = write(scratch, "o.csv", 'A,"B\nC",A,CL,S\n')
    assert [(r.artist, r.song, r.country) for r in read_extension(spark, broken).collect()] == [("A", "B\nC", "CL")]
    with pytest.raises(Exception, match="quote left open in line"):
        read_extension(spark, broken, line_breaks=False).collect()
    with pytest.raises(ValueError, match="quote left open at the end of .*o2.csv"):
        read_extension(spark, write(scratch, "o2.csv", 'A,"B\nC,A,CL,S\n'))
    spaced = write(scratch, "s.csv", ' A , S\n"",""\n,\n')
    assert [(r.artist, r.song) for r in read_pairs(spark, spaced).orderBy("ord").collect()] == [(" A ", " S"), ("", ""), ("", "")]


def test_width_counts_one_field_more_than_asked(spark, scratch):
    p = write(scratch, "w.csv", "a\na,b\na,b,c\na,b,c,d\na,,\n")
    rows = parse_delimited(raw_lines(spark, p), ["x", "y"]).orderBy("ord").collect()
    assert [(r.x, r.y, r.width) for r in rows] == [("a", None, 1), ("a", "b", 2), ("a", "b", 3), ("a", "b", 3), ("a", "", 3)]


def test_one_scan_per_report(spark, scratch):
    from hitlens.operators.charts import top_artists

    p = write(scratch, "r.csv", "Position,Track Name,Artist,Streams,URL,Date,Region\n1,T,X,10,u,2017-01-01,cl\n")
    plan = top_artists(read_ranking(spark, p), "cl")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1


def test_file_order_across_files(spark, scratch):
    for i in range(3):
        write(scratch, f"part-{i}.csv", "artist,song\n" + "".join(f"a{i}-{j},s\n" for j in range(50)))
    df = read_pairs(spark, scratch)
    assert df.count() == 150
    ordered = [r.artist for r in parse_delimited(raw_lines(spark, scratch), ["artist", "song"]).orderBy("ord").collect()]
    assert ordered == [x for i in range(3) for x in ["artist"] + [f"a{i}-{j}" for j in range(50)]]


def test_ranking_short_row_fails(spark, scratch):
    header = "Position,Track Name,Artist,Streams,URL,Date,Region\n"
    good = write(scratch, "good.csv", header + '1,"Hey, you",X,10,u,2017-01-01,cl\n')
    r = read_ranking(spark, good).first()
    assert (r.position, r.track, r.region) == ("1", "Hey, you", "cl")
    bad = write(scratch, "bad.csv", header + "1,T,X,10\n")
    with pytest.raises(Exception):
        read_ranking(spark, bad).collect()
    assert read_ranking(spark, bad, on_short="keep").first().date is None


def test_series_tsv_rules(spark, scratch):
    lines = [
        "t1\tx\t8.0\tShow\t2001\tz\tTV_SERIES\te1",
        "t2\tx\t6.0\tShow\t2001\tz\tTV_SERIES\t\tmore",
        "t3\tx\t1.0\tShow\t2001\tz\tTV_SERIES\t",
    ]
    p = write(scratch, "r.tsv", "\n".join(lines) + "\n")
    got = [tuple(r) for r in read_series(spark, p).collect()]
    assert got == [
        ("8.0", "Show", "2001", "TV_SERIES", "e1"),
        ("6.0", "Show", "2001", "TV_SERIES", ""),
        ("1.0", "Show", "2001", "TV_SERIES", None),
    ]


def test_read_lines(spark, scratch):
    p = write(scratch, "t.txt", "a b\n\nc\n")
    assert [r.value for r in read_lines(spark, p).collect()] == ["a b", "", "c"]


@pytest.fixture()
def small_splits(spark):
    """Splits of few bytes, so that records cross many of them."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def broken_records(seed, n):
    rng = random.Random(seed)
    pieces = ["a", "b,", '"', "\n", "\n\n", "x y", '""', "é", ""]
    return [["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 5))] for _ in range(n)]


@pytest.mark.parametrize("seed, split", [(1, 40), (2, 150), (3, 7), (4, 1 << 20)])
def test_line_breaks_inside_quotes_over_splits(spark, scratch, small_splits, seed, split):
    import duckdb

    rows = [r + [""] * (4 - len(r)) for r in broken_records(seed, 60)]
    rows[10] = ["one record", "over\n" * 60, "many", "splits"]
    p = os.path.join(scratch, "r.csv")
    with open(p, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL if seed % 2 else csv.QUOTE_MINIMAL).writerows(rows)
    plain = write(scratch, "plain.csv", "p,q\nr,s\n")
    small_splits(split)
    got = read_delimited(spark, [p, plain], "abcd").orderBy("ord").collect()
    with open(p, encoding="utf-8") as f:
        want = [r for r in csv.reader(f) if r]
    assert [[r.a, r.b, r.c, r.d] for r in got[:-2]] == want
    assert [(r.a, r.b, r.c, r.width) for r in got[-2:]] == [("p", "q", None, 2), ("r", "s", None, 2)]
    # DuckDB skips no blank record here: every record has four fields.
    theirs = duckdb.sql(f"SELECT * FROM read_csv('{p}', header=false, all_varchar=true, delim=',', quote='\"', escape='\"', "
                        "columns={'a': 'VARCHAR', 'b': 'VARCHAR', 'c': 'VARCHAR', 'd': 'VARCHAR'}, nullstr='\x01', auto_detect=false)").fetchall()
    assert sorted(theirs) == sorted(map(tuple, want))


def test_quotes_as_the_csv_module_reads_them(spark):
    from hitlens.sources.records import leaves_open

    rng = random.Random(8)
    lines = ["".join(rng.choice('",ab ') for _ in range(rng.randrange(0, 12))) for _ in range(3000)]

    def open_after(line):
        row = next(csv.reader(iter([line + "\n", "\x01\n"])))
        return any("\x01" in field for field in row)

    got = spark.createDataFrame([(x,) for x in lines], "v string").select("v", leaves_open(F.col("v")).alias("o"), leaves_open(F.col("v"), inside=True).alias("i")).collect()
    assert all(r.o == open_after(r.v) and r.i == open_after('"' + r.v) for r in got)


def test_long_fields_and_long_records(spark, scratch):
    rows = [["x" * 200_000, 'q"' * 3000, "\n".join(map(str, range(5000))), "end"], ["e", "f", "g", "h"]]
    p = os.path.join(scratch, "long.csv")
    with open(p, "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)
    assert [[r.a, r.b, r.c, r.d] for r in read_delimited(spark, p, "abcd").orderBy("ord").collect()] == rows


def test_skip_by_count_per_path(spark, scratch, small_splits):
    small_splits(16)
    one = write(scratch, "one.csv", 'artist,song,result_artist,country,starting_place\n\nA,"S\nT",R,CL,P\nB,S,R,CL,P\n' * 1 + "C,S,R,CL,P\n" * 30)
    two = write(scratch, "two.csv", "FIRST,S,R,CL,P\nSECOND,S,R,CL,P\nTHIRD,S,R,CL,P\n")
    parts = os.path.join(scratch, "parts")
    os.makedirs(parts)
    for i, n in enumerate((1, 1, 3)):
        write(parts, f"part-{i}", "".join(f"p{i}{j},S,R,CL,P\n" for j in range(n)))
    got = [(r.artist, r.song) for r in read_extension(spark, [one, two, parts], skip=2).orderBy("ord").collect()]
    assert got == [("A", "S\nT"), ("B", "S")] + [("C", "S")] * 30 + [("THIRD", "S")] + [(f"p2{j}", "S") for j in range(3)]
    plan = read_extension(spark, [two, parts], skip=2, line_breaks=False)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # a task passes on its first two per path
    assert read_extension(spark, two, skip=9).count() == 0 and read_extension(spark, two, skip=0).count() == 3


def test_many_paths_are_one_scan(spark, scratch):
    days = os.path.join(scratch, "days+of 2017")
    os.makedirs(days)
    names = [f"day {i % 97} {i}.csv" for i in range(200)]
    paths = [write(days, name, f"{name},x\n{name},y\n") for name in names]
    df = read_pairs(spark, paths, line_breaks=False)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan text") == 1 and "Union" not in text and "BroadcastHashJoin" in text
    assert [r.artist for r in df.orderBy("ord").collect()] == [n for n in names for _ in range(2)]
    # Folders, patterns, URIs and a path given twice keep their places too.
    other = os.path.join(scratch, "other")
    os.makedirs(other)
    for i in (2, 1):
        write(other, f"part-{i}", f"o{i},s\n")
    mixed = [paths[5], "file://" + other, os.path.join(days, "day 3 *.csv"), paths[5], paths[0]]
    found = [r.artist for r in read_pairs(spark, mixed).orderBy("ord").collect()]
    globbed = sorted(n for n in names if n.startswith("day 3 "))
    assert found == [names[5]] * 2 + ["o1", "o2"] + [n for n in globbed for _ in range(2)] + [names[5]] * 2 + [names[0]] * 2


def test_a_line_is_judged_once_and_its_unread_place_is_not_made(spark, scratch):
    p = write(scratch, "r.csv", "Position,Track Name,Artist,Streams,URL,Date,Region\n1,T,A,5,u,2017-01-01,cl\n")
    rows = read_ranking(spark, p).select("artist", "track")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("quote left open") == 1 and "regexp_extract" not in plan
    assert [tuple(r) for r in rows.collect()] == [("A", "T")]
