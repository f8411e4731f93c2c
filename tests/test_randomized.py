"""Randomized cross-checks of the two custom joins against their brute-force restatements.

A tiny alphabet makes matches dense: short and empty needles, keys present in
most haystacks, ties on scores and shared ids all occur.
"""

import random

import pytest

from hitlens.operators import enrich
from hitlens.operators.enrich import enrich_ranking
from hitlens.operators.resolve import resolve_pairs
from tests.test_enrich import RANK, EXT, brute_force as enrich_brute
from tests.test_resolve import AH, WH


def word(rng, alphabet="abAB &", max_len=6):
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, max_len)))


@pytest.mark.parametrize("seed, grams, extended, hot", [(1, (3, 6), (12, 24), 256), (3, (2, 3), (4, 5), 4), (4, (2, 4), (5,), 2), (5, (3, 4), (), 1)])
def test_enrichment_matches_brute_force(spark, monkeypatch, seed, grams, extended, hot):
    for name, value in {"GRAMS": grams, "EXTENDED": extended, "HOT": hot, "PAIRED": 1 + seed % 2, "BLOCK": 1 + seed, "FIRST": 1 + seed, "FACTOR": 2}.items():
        monkeypatch.setattr(enrich, name, value)
    rng = random.Random(seed)
    ranking = [(str(i), word(rng, max_len=4), word(rng, max_len=3), "1", "u", "d", "r") for i in range(150)]
    ext = []
    for i in range(80):
        width = rng.choice([3, 4, 5, 5, 5])
        country = (rng.choice(["", "CL", "AR"]) if width >= 4 else None)
        place = rng.choice(["", "P", "Q"]) if width >= 5 else None
        ext.append((rng.randint(0, 10_000) * 100 + i, word(rng, max_len=8), word(rng, max_len=8), country, place))
    out = enrich_ranking(spark.createDataFrame(ranking, RANK), spark.createDataFrame(ext, EXT))
    got = sorted((r.track, r.artist, r.date, r.region, r.country, r.begin_area) for r in out.collect())
    rank_dicts = [dict(zip(["position", "track", "artist", "streams", "url", "date", "region"], r)) for r in ranking]
    ext_dicts = [dict(zip(["ord", "artist", "song", "country", "starting_place"], e)) for e in ext]
    assert got == enrich_brute(rank_dicts, ext_dicts)
    assert {r[4] == "NONE" for r in got} == {True, False}


def resolve_brute(requests, ahits, whits):
    out = []
    for artist, song in requests:
        a = artist.lower().replace("&", "").replace("  ", " ")
        s = song.lower()
        final, just = [], []
        for q, _, name, country, arid, begin in sorted((h for h in ahits if h[0] == a), key=lambda h: h[1]):
            ln = (name or "").lower()
            hit = (name or "", country or "", begin or "")
            if a in ln or artist in ln:
                just.append((abs(len(ln) - len(artist)), hit))
            for wq, _, warid, title in sorted((w for w in whits if w[0] == s), key=lambda w: w[1]):
                if (warid or "") == (arid or "") and a in ln and s in title.lower():
                    final.append((abs(len(ln) - len(a)) + abs(len(title.lower()) - len(s)), hit))
        pick = min(final, key=lambda x: x[0], default=None) or min(just, key=lambda x: x[0], default=None)
        out.append((artist, song) + (pick[1] if pick else ("", "", "")))
    return sorted(out)


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_resolution_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    artists = sorted({word(rng, "aB& ", 4) for _ in range(12)})
    songs = sorted({word(rng, "xY", 3) for _ in range(6)})
    requests = sorted({(rng.choice(artists), rng.choice(songs)) for _ in range(40)})
    norms = sorted({a.lower().replace("&", "").replace("  ", " ") for a, _ in requests})
    ids = ["", "i1", "i2", "i3", None]
    ahits = [(rng.choice(norms), i, word(rng, "aAbB& ", 7), rng.choice(["", "CL"]), rng.choice(ids),
              rng.choice(["", "P"])) for i in range(60)]
    whits = [(rng.choice([s.lower() for s in songs]), i, rng.choice(ids), word(rng, "xXyY ", 5)) for i in range(60)]
    got = resolve_pairs(
        spark.createDataFrame(requests, "artist string, song string"),
        spark.createDataFrame(ahits, AH),
        spark.createDataFrame(whits, WH),
    )
    result = sorted(tuple(r) for r in got.collect())
    assert result == resolve_brute(requests, ahits, whits)
    assert {r[2] == "" for r in result} == {True, False}
