"""Pair resolution: rule cases and a brute-force restatement on the derived tables."""

from hitlens.operators.candidates import flatten_artists, flatten_works
from hitlens.operators.resolve import resolve_pairs
from hitlens.plans import fixtures
from hitlens.plans.registry import ARTIST_ORDER, WORK_ORDER
from tests.conftest import SF_SMALL

AH = "query string, ord long, name string, country string, arid string, begin_area string"
WH = "query string, ord long, arid string, title string"


def resolve(spark, requests, ahits, whits):
    req = spark.createDataFrame(requests, "artist string, song string")
    out = resolve_pairs(req, spark.createDataFrame(ahits, AH), spark.createDataFrame(whits, WH))
    return sorted(tuple(r) for r in out.collect())


def test_work_backed_beats_artist_only(spark):
    ahits = [("shakira", 1, "Shakira", "CO", "id1", "Barranquilla"), ("shakira", 2, "Shakira Tribute", "US", "id2", "")]
    whits = [("loca", 1, "id2", "Loca"), ("loca", 2, "id1", "Loca (remix!)")]
    # id2 scores 8 + 0, id1 scores 0 + 9: the tribute act wins on the total.
    assert resolve(spark, [("Shakira", "Loca")], ahits, whits) == [("Shakira", "Loca", "Shakira Tribute", "US", "")]


def test_equal_scores_take_first_candidate_then_first_work(spark):
    ahits = [("a", 2, "A", "X", "i2", "p2"), ("a", 1, "A", "Y", "i1", "p1")]
    whits = [("s", 1, "i1", "S"), ("s", 0, "i2", "S")]
    assert resolve(spark, [("A", "S")], ahits, whits) == [("A", "S", "A", "Y", "p1")]


def test_empty_ids_join_each_other(spark):
    ahits = [("a", 1, "A", "X", None, "p")]
    whits = [("s", 1, "", "S")]
    assert resolve(spark, [("A", "S")], ahits, whits) == [("A", "S", "A", "X", "p")]


def test_artist_only_fallback_and_raw_name_arm(spark):
    ahits = [("ab c", 1, "AB & C", "CL", "i1", "P"), ("ab c", 2, "AB C Band", "AR", "i2", "Q")]
    # normalised 'ab c' is not in 'ab & c', but the original lower-case name is
    assert resolve(spark, [("ab & c", "zzz")], ahits, []) == [("ab & c", "zzz", "AB & C", "CL", "P")]


def test_no_candidate_gives_blanks(spark):
    assert resolve(spark, [("Nobody", "x")], [], []) == [("Nobody", "x", "", "", "")]


def brute_force(requests, ahits, whits):
    """Direct restatement of the per-pair search, candidates and works in document order."""
    by_query_a, by_query_w = {}, {}
    for h in sorted(ahits, key=lambda h: (h["page"], h["pos"])):
        by_query_a.setdefault(h["query"], []).append(h)
    for w in sorted(whits, key=lambda w: (w["page"], w["pos"], w["item"])):
        by_query_w.setdefault(w["query"], []).append(w)
    out = []
    for artist, song in requests:
        a = artist.lower().replace("&", "").replace("  ", " ")
        s = song.lower()
        final, just = [], []
        for c in by_query_a.get(a, []):
            ln = c["name"].lower()
            if a in ln or artist in ln:
                just.append((abs(len(ln) - len(artist)), c))
            for w in by_query_w.get(s, []):
                if w["arid"] == c["arid"] and a in ln and s in w["title"].lower():
                    final.append((abs(len(ln) - len(a)) + abs(len(w["title"].lower()) - len(s)), c))
        pick = min(final, key=lambda x: x[0], default=None) or min(just, key=lambda x: x[0], default=None)
        if pick:
            c = pick[1]
            out.append((artist, song, c["name"], c["country"], c["begin_area"]))
        else:
            out.append((artist, song, "", "", ""))
    return sorted(out)


def test_matches_brute_force_on_derived_tables(spark):
    req = fixtures.requests(spark, SF_SMALL)
    ah = flatten_artists(fixtures.artist_documents(spark, SF_SMALL))
    wh = flatten_works(fixtures.work_documents(spark, SF_SMALL))
    expected = brute_force(
        [tuple(r) for r in req.collect()], [r.asDict() for r in ah.collect()], [r.asDict() for r in wh.collect()]
    )
    got = sorted(tuple(r) for r in resolve_pairs(req, ah, wh, ARTIST_ORDER, WORK_ORDER).collect())
    assert got == expected
    kinds = {(r[2] != "", r[1] == "zzz") for r in got}
    assert {(True, False), (True, True), (False, False)} <= kinds


def test_shared_empty_id_forms_no_product(spark):
    from hitlens.operators.resolve import related_works

    n = 60
    ahits = [("a", i, "A" + "x" * (i % 7), "C", "", "P") for i in range(n)]
    whits = [("s", i, "", "S" + "y" * (i % 5)) for i in range(n)]
    req = spark.createDataFrame([("A", "S")], "artist string, song string")
    rel = related_works(req, spark.createDataFrame(ahits, AH), spark.createDataFrame(whits, WH))
    rows = rel.collect()
    assert len(rows) == 1  # one row per (request, id), not n * n candidate-work pairs
    assert (rows[0].score, rows[0].a_ord.a0, rows[0].w_ord.w0) == (0, 0, 0)


def most_rows(df):
    """Run ``df``; the most rows that any join of its final plan made."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    todo, most = [qe.executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if "Join" in kind:
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_popular_id_does_not_multiply(spark):
    from hitlens.operators.resolve import related_works

    n = 1000
    ahits = [(f"artist {i}", i, f"Artist {i}", "C", "id", "P") for i in range(n)] + [(f"artist {i}", i, f"Artist {i} x", "C", f"own{i}", "P") for i in range(n)]
    whits = [(f"song {i}", i, "id", f"Song {i}") for i in range(n)] + [(f"song {i}", i, f"own{i}", f"Song {i} y") for i in range(n)]
    # Every query is asked, but each by one pair, and only ten pairs share their number.
    asked = [(f"Artist {i}", f"Song {i if i < 10 else (i * 7 + 1) % n}") for i in range(n)]
    req = spark.createDataFrame(asked, "artist string, song string")
    ah, wh = spark.createDataFrame(ahits, AH), spark.createDataFrame(whits, WH)
    rel = related_works(req, ah, wh)
    assert most_rows(rel) <= 2 * n + 8 * 4 * n  # the id alone would make a million
    got = {(r.artist, r.song, r.arid) for r in related_works(req, ah, wh).collect()}
    want = {(a, s, "id") for a, s in asked} | {(a, s, f"own{a.split()[1]}") for a, s in asked if a.split()[1] == s.split()[1]}
    assert got == want


def test_every_split_of_ids_gives_the_same(spark):
    from hitlens.operators.resolve import related_works

    ahits = [(f"a{q}", 10 * q + i, f"A{q}", "C", f"i{(q * i) % 5}", "P") for q in range(8) for i in range(6)]
    whits = [(f"s{q}", 10 * q + i, f"i{(q + i) % 5}", f"S{q}") for q in range(8) for i in range(6)]
    req = spark.createDataFrame([(f"A{i}", f"S{j}") for i in range(8) for j in range(8) if (i + j) % 3], "artist string, song string")
    ah, wh = spark.createDataFrame(ahits, AH), spark.createDataFrame(whits, WH)
    results = [sorted(map(str, related_works(req, ah, wh, light=n).collect())) for n in (0, 3, 100)]
    assert results[0] and results[0] == results[1] == results[2]


def test_what_makes_the_requests_runs_once_for_the_reductions(spark, monkeypatch):
    from hitlens.operators import resolve as r

    stored, made = r.Intermediates.stored, []

    def noted(self, df, name):
        made.append((name, "Range (" in df._jdf.queryExecution().optimizedPlan().toString()))
        return stored(self, df, name)

    monkeypatch.setattr(r.Intermediates, "stored", noted)
    req = spark.range(40).selectExpr("concat('a', id % 2) artist", "concat('s', id % 3) song")
    got = resolve_pairs(req, spark.createDataFrame([("a1", 0, "A1 x", "CL", "7", "P")], AH), spark.createDataFrame([("s2", 0, "7", "The S2")], WH))
    assert [name for name, of_source in made if of_source] == ["resolve-requests"]
    # Every request row stays, repeated ones too.
    assert got.count() == 40 and got.where("result_artist = 'A1 x'").count() == 20
