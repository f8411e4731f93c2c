"""The command line runs each job from files to files."""

import glob
import os

from hitlens.__main__ import run

HEADER = "Position,Track Name,Artist,Streams,URL,Date,Region\n"


def write(directory, name, text):
    path = os.path.join(directory, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def lines(path):
    return [ln for f in sorted(glob.glob(path + "/**/part-*", recursive=True)) for ln in open(f).read().splitlines()]


def test_reports(spark, scratch):
    ranking = write(scratch, "r.csv", HEADER + "1,S,A,10,u,2017-12-25,cl\n1,T,B,20,u,2017-12-25,cl\n2,S,A,5,u,2017-12-25,ar\n")
    run(spark, ["top-artists", ranking, scratch + "/a", "--region", "cl"])
    assert lines(scratch + "/a") == ["(20,B)", "(10,A)"]
    run(spark, ["top-songs", ranking, scratch + "/s", "--date", "2017-12-25", "--top", "1"])
    assert lines(scratch + "/s") == ["(20,T#B)"]
    run(spark, ["top-position-counts", ranking, scratch + "/p"])
    assert lines(scratch + "/p") == ["(1,S#A)", "(1,T#B)"]
    run(spark, ["distinct-pairs", ranking, scratch + "/d"])
    assert sorted(ln for ln in lines(scratch + "/d") if ln != "artist,song") == ["A,S", "B,T"]


def test_counts_and_means(spark, scratch):
    text = write(scratch, "t.txt", "a b a\nb\n")
    run(spark, ["word-count", text, scratch + "/w"])
    assert sorted(lines(scratch + "/w")) == ["(a,2)", "(b,2)"]
    tsv = write(scratch, "r.tsv", "t\tx\t8.0\tShow\t2001\tz\tTV_SERIES\te1\nt\tx\t6.0\tShow\t2001\tz\tTV_SERIES\te2\n")
    run(spark, ["series-mean", tsv, scratch + "/m"])
    assert lines(scratch + "/m") == ["(Show#2001,7.0)"]


def test_resolve_then_enrich(spark, scratch):
    pairs = write(scratch, "pairs.csv", "artist,song\n" + "".join(f"Nobody {i},x\n" for i in range(20)) + "Shakira,Loca\n")
    apages, wpages = os.path.join(scratch, "ap"), os.path.join(scratch, "wp")
    os.makedirs(apages), os.makedirs(wpages)
    write(apages, "shakira.xml", '<metadata><artist-list count="1"><artist id="i1"><name>Shakira</name>'
          "<country>CO</country><begin-area><name>Barranquilla</name></begin-area></artist></artist-list></metadata>")
    write(wpages, "loca.xml", '<metadata><work-list count="1"><work><title>Loca</title><relation-list target-type="artist">'
          '<relation><artist id="i1"><name>Shakira</name></artist></relation></relation-list></work></work-list></metadata>')
    run(spark, ["resolve", pairs, apages, wpages, scratch + "/resolved"])
    resolved = [ln for ln in lines(scratch + "/resolved") if not ln.startswith("artist,")]
    assert resolved == [f"Nobody {i},x,,," for i in range(20)] + ["Shakira,Loca,Shakira,CO,Barranquilla"]
    ranking = write(scratch, "rank.csv", HEADER + "1,Loca,Shakira,10,u,d,co\n2,x,Nobody 0,9,u,d,co\n")
    run(spark, ["enrich", ranking, scratch + "/resolved", scratch + "/e"])
    assert lines(scratch + "/e")[1:] == ["1,Loca,Shakira,10,u,d,co,CO,Barranquilla", "2,x,Nobody 0,9,u,d,co,,"]
