"""Origin enrichment: hand-made rule cases and a brute-force restatement."""

import pytest
from pyspark.sql import functions as F

from hitlens.operators.enrich import enrich_ranking
from hitlens.plans.fixtures import chart, extension
from tests.conftest import SF_SMALL

RANK = "position string, track string, artist string, streams string, url string, date string, region string"
EXT = "ord long, artist string, song string, country string, starting_place string"


def enrich(spark, ranking, ext, **kw):
    out = enrich_ranking(spark.createDataFrame(ranking, RANK), spark.createDataFrame(ext, EXT), **kw)
    return sorted((r.track, r.artist, r.country, r.begin_area) for r in out.collect())


def row(track, artist):
    return ("1", track, artist, "10", "u", "2017-01-01", "cl")


def test_last_match_wins_even_with_empty_country(spark):
    ext = [(1, "Artist X", "Song One", "CL", "Santiago"), (2, "artist x", "song one (remix)", "", "Lima")]
    assert enrich(spark, [row("Song One", "Artist X")], ext) == [("Song One", "Artist X", "", "Lima")]


def test_short_later_match_is_ignored(spark):
    ext = [(1, "A", "S", "CL", "Santiago"), (2, "A", "S", None, None)]
    assert enrich(spark, [row("S", "A")], ext) == [("S", "A", "CL", "Santiago")]


def test_four_field_match_has_no_begin_area(spark):
    ext = [(1, "A", "S", "CL", None)]
    assert enrich(spark, [row("S", "A")], ext) == [("S", "A", "CL", "NONE")]


def test_empty_track_matches_every_song_of_artist(spark):
    ext = [(1, "A", "x", "CL", "P"), (5, "A", "y", "AR", "Q"), (3, "B", "z", "US", "R")]
    assert enrich(spark, [row("", "A")], ext) == [("", "A", "AR", "Q")]


def test_empty_needles_match_the_last_row(spark):
    ext = [(1, "A", "x", "CL", "P"), (9, "B", "z", "US", "R"), (5, "A", "y", "AR", "Q")]
    assert enrich(spark, [row("", "")], ext) == [("", "", "US", "R")]


def test_short_needles_use_exact_short_keys(spark):
    ext = [(1, "Xa", "Yb", "CL", "P"), (2, "ab", "yz", "AR", "Q")]
    got = enrich(spark, [row("y", "a"), row("b", "x"), row("q", "a")], ext)
    assert got == [("b", "x", "CL", "P"), ("q", "a", "NONE", "NONE"), ("y", "a", "AR", "Q")]


def test_comma_needle_does_not_match_stripped_haystack(spark):
    ext = [(1, "A", "Me Myself", "CL", "P")]
    assert enrich(spark, [row("Me, Myself", "A")], ext) == [("Me Myself", "A", "NONE", "NONE")]
    assert enrich(spark, [row("Me, Myself", "A")], ext, strip_before_match=True) == [("Me Myself", "A", "CL", "P")]


def test_unmatched_rows_are_kept(spark):
    ext = [(1, "Z", "Q", "CL", "P")]
    assert enrich(spark, [row("S", "A"), row("S", "A")], ext) == [("S", "A", "NONE", "NONE")] * 2


def brute_force(ranking_rows, ext_rows):
    """Direct restatement: scan the extension in order for every ranking row."""
    ext_rows = sorted((e for e in ext_rows if e["country"] is not None and e["song"] is not None), key=lambda e: e["ord"])
    lower = [(e["artist"].lower(), e["song"].lower(), e) for e in ext_rows]
    found, out = {}, []
    for r in ranking_rows:
        key = r["artist"].lower(), r["track"].lower()
        if key not in found:
            found[key] = "NONE", "NONE"
            for artist, song, e in lower:
                if key[0] in artist and key[1] in song:
                    found[key] = e["country"], e["starting_place"] if e["starting_place"] is not None else "NONE"
        out.append((r["track"].replace(",", ""), r["artist"].replace(",", ""), r["date"], r["region"], *found[key]))
    return sorted(out)


def test_matches_brute_force_on_derived_tables(spark):
    ranking = chart(spark, SF_SMALL)
    ext = extension(spark, SF_SMALL)
    expected = brute_force([r.asDict() for r in ranking.collect()], [e.asDict() for e in ext.collect()])
    got = sorted(
        (r.track, r.artist, r.date, r.region, r.country, r.begin_area)
        for r in enrich_ranking(ranking, ext).collect()
    )
    assert len(got) == 5893
    assert got == expected


def test_intermediates_go_to_the_shared_folder(spark):
    import glob
    import os

    from hitlens.session import drop_stored

    shared = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(glob.glob(os.path.join(shared, "enrich-*")))
    ext = [(1, "A", "S", "CL", "P")]
    out = enrich(spark, [row("S", "A")], ext)
    assert out == [("S", "A", "CL", "P")]
    written = set(glob.glob(os.path.join(shared, "enrich-*"))) - before
    # The others are deleted as soon as the answers are written.
    assert {os.path.basename(p).rsplit("-", 1)[0] for p in written} == {"enrich-answers"}
    drop_stored(spark, *(spark.sparkContext.getCheckpointDir().rstrip("/") + "/" + os.path.basename(p) for p in written))
    assert not set(glob.glob(os.path.join(shared, "enrich-*"))) - before
    with pytest.raises(ValueError):
        drop_stored(spark, "/somewhere/else")


def hot_inputs(spark):
    """5,000 origins in which every 6-gram of "the band" and "love song" is in nearly all."""
    from hitlens.operators.enrich import last_matches

    ext = [(i, f"The Band {i % 50}", f"Love Song {i}" if i % 50 != 49 else f"Tune {i}", f"C{i}", "P") for i in range(5000)]
    return ext, last_matches(spark.createDataFrame(ext, EXT))


def test_needles_with_hot_keys_stop_at_their_match(spark):
    from hitlens.operators import enrich as e

    ext, haystacks = hot_inputs(spark)
    asked = [("the band", "love song"), ("the band 7", "love song"), ("the band", "love song 1"), ("", "love song"), ("band 4", "song 27"),
             ("the", "ong"), ("the band 4", "love song 12"), ("band 49", "love song"), ("the band 13", "love song 4963"), ("the band", "love song 3"), ("x", "y")]
    needles = spark.createDataFrame(asked, "la string, lt string")
    rank = {}
    for la, lt in asked:
        for r, (_, a, s, c, _) in enumerate(reversed(ext)):
            if la in a.lower() and lt in s.lower():
                rank[la, lt] = r + 1, c
                break
    effort = {(r.la, r.lt): r for r in e.match_effort(needles, haystacks).collect()}
    assert sum(r.n > 1000 for r in effort.values()) >= 5
    assert {k for k, r in effort.items() if r.matched} == set(rank)
    for k, (place, _) in rank.items():
        assert effort[k].verified < e.FIRST + e.FACTOR * place + 2 * e.BLOCK
    # Without a match, the postings of the rarest key are all that is verified.
    assert all(r.verified <= r.n for r in effort.values() if not r.matched)
    got = {(r.la, r.lt): r.country for r in e.containment_match(needles, haystacks).collect()}
    assert got == {k: c for k, (_, c) in rank.items()}


def test_hot_keys_are_extended(spark):
    from hitlens.operators import enrich as e
    from hitlens.session import Intermediates

    _, haystacks = hot_inputs(spark)
    tables = Intermediates(spark)
    needles = spark.createDataFrame([("the band", f"love song {i}") for i in range(1000, 1040) if i % 50 != 49], "la string, lt string")
    origins = tables.stored(e.latest_first(haystacks), "origins")
    picked, lengths = e.picked_keys(tables.stored(needles, "needles"), origins, tables)
    # Each of their 6-grams has ten postings at least, most thousands; a 12-gram holds the whole number.
    assert lengths == [6] and max(r.n for r in picked.collect()) <= e.HOT
    asked = spark.createDataFrame([("the band", "love song 1")], "la string, lt string")
    picked, lengths = e.picked_keys(tables.stored(asked, "needles"), origins, tables)
    assert lengths == [6] and picked.first().n > e.HOT  # too short for a longer key
    longer = spark.createDataFrame([("the band 1", "xx love song 1")], "la string, lt string")
    assert e.picked_keys(tables.stored(longer, "needles"), origins, tables)[0].isEmpty()
    tables.drop()


def test_only_picked_keys_are_indexed(spark):
    from hitlens.operators import enrich as e

    _, haystacks = hot_inputs(spark)
    asked = spark.createDataFrame([("band 7", "ong 4907")], "la string, lt string")
    keyed = e._keyed(asked, e._first_keys(F.col("la")), e._first_keys(F.col("lt")))
    counts = e.key_counts(haystacks.withColumn("hid", F.col("hord")), keyed, [3, 6])
    assert counts.count() == keyed.select("k").distinct().count() == 4
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "LeftSemi" in plan


def test_needles_verify_few_rows_where_first_keys_are_shared(spark):
    from hitlens.operators import enrich as e

    # Every 6-gram of these songs is in 50 origins or more; a 12-gram over the dashes is in one.
    song = lambda a, b: f"tune {a:02d}{a:02d}{a:02d} --- {b:02d}{b:02d}{b:02d}"
    ext = [(a * 50 + b, "The Band", song(a + 10, b + 10), f"C{a}-{b}", "P") for a in range(50) for b in range(50)]
    haystacks = e.last_matches(spark.createDataFrame(ext, EXT))
    needles = spark.createDataFrame([("band", song(a + 10, a + 20)) for a in range(40)], "la string, lt string")
    effort = e.match_effort(needles, haystacks).collect()
    assert len(effort) == 40 and all(r.matched and r.verified <= e.HOT for r in effort)
    got = {r.lt: r.country for r in e.containment_match(needles, haystacks).collect()}
    assert got == {song(a + 10, a + 20): f"C{a}-{a + 10}" for a in range(40)}


def test_unpicked_frequent_keys_are_not_indexed(spark):
    from hitlens.operators import enrich as e

    postings = spark.createDataFrame([(1, i) for i in range(9)] + [(2, i) for i in range(9)] + [(3, 1)], "k long, hid long")
    frequent = spark.createDataFrame([(1,), (2,)], "k long")
    got = e._indexed(postings, frequent, spark.createDataFrame([(2,), (3,), (3,)], "k long"))
    assert sorted((r.k, r.hid) for r in got.collect()) == [(2, i) for i in range(9)] + [(3, 1)]
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_many_answers_are_hashed_and_their_keys_not_shuffled(spark, monkeypatch):
    from hitlens.operators import enrich as e

    ranking = spark.createDataFrame(
        [(i, t, a, i * 2, "u", "d", "r") for i, (t, a) in enumerate([("Song, A", "X"), ("song, a", "x"), ("Song, A", "X"), ("B", "Y"), (None, "X"), ("B", None), ("", "")])],
        "position int, track string, artist string, streams long, url string, date string, region string")
    extension = spark.createDataFrame(
        [(1, "x", "song, a b", "CL", "P"), (2, "X and", "the SONG, A", "PE", None), (3, "y", "B", None, None), (4, "q", "z", "AR", "Q")],
        "ord long, artist string, song string, country string, starting_place string")

    def got(strip):
        df = enrich_ranking(ranking, extension, strip_before_match=strip)
        return df._jdf.queryExecution().optimizedPlan().toString(), sorted(map(str, df.collect()))

    for strip in (False, True):
        plan, rows = got(strip)
        assert "shuffle_hash" not in plan and any("'PE'" in r for r in rows) != strip
        with monkeypatch.context() as m:
            m.setattr(e, "MANY", 0)
            hashed, same = got(strip)
            assert "strategy=shuffle_hash" in hashed and "AS la" not in hashed and same == rows
            m.setattr(e, "HASHED", 0)
            merged, same = got(strip)
            assert "shuffle_hash" not in merged and same == rows
