"""Flattening stored artist and work response documents."""

from hitlens.operators.candidates import flatten_artists, flatten_works
from tests.conftest import rows


def docs(spark, *xml):
    return spark.createDataFrame([("q", i, d) for i, d in enumerate(xml)], "query string, page long, doc string")


def test_artist_list_one_many_none(spark):
    one = '<metadata><artist-list count="1"><artist id="a1"><name>Solo</name></artist></artist-list></metadata>'
    many = (
        '<metadata><artist-list count="2">'
        '<artist id="a2"><name> A &amp; B </name><country>CL</country><begin-area><name>Santiago</name></begin-area></artist>'
        '<artist><name>C</name><begin-area></begin-area></artist>'
        "</artist-list></metadata>"
    )
    none = '<metadata><artist-list count="0"/></metadata>'
    out = rows(flatten_artists(docs(spark, one, many, none)), "page", "pos", "name", "country", "arid", "begin_area")
    assert out == [
        (0, 0, "Solo", "", "a1", ""),
        (1, 0, "A & B", "CL", "a2", "Santiago"),
        (1, 1, "C", "", "", ""),
    ]


def test_work_list_keeps_only_artist_relations(spark):
    doc = (
        '<metadata><work-list count="3">'
        "<work><title>Song</title>"
        '<relation-list target-type="label"><relation><artist id="x"><name>Label</name></artist></relation></relation-list>'
        '<relation-list target-type="artist">'
        '<relation><artist id="a1"><name>One</name></artist></relation>'
        '<relation><artist id="a2"><name>Two</name></artist></relation>'
        "</relation-list></work>"
        "<work><title>No relations</title></work>"
        '<work><relation-list target-type="artist"><relation><artist id="a3"><name>Three</name></artist>'
        "</relation></relation-list></work>"
        "</work-list></metadata>"
    )
    out = rows(flatten_works(docs(spark, doc)), "pos", "item", "arid", "name", "title")
    assert out == [(0, 0, "a1", "One", "Song"), (0, 1, "a2", "Two", "Song"), (2, 0, "a3", "Three", "")]


def test_response_files(spark, scratch):
    import os

    from hitlens.sources import read_response_files

    for q, name in (("madonna", "Madonna"), ("prince", "Prince")):
        with open(os.path.join(scratch, f"{q}.xml"), "w") as f:
            f.write(f'<metadata><artist-list count="1"><artist id="{q}1"><name>{name}</name>'
                    "</artist></artist-list></metadata>\n")
    out = rows(flatten_artists(read_response_files(spark, scratch)), "query", "name", "arid")
    assert out == [("madonna", "Madonna", "madonna1"), ("prince", "Prince", "prince1")]


def test_response_files_with_pages(spark, scratch):
    import os

    from hitlens.sources import read_response_files

    def page(names):
        items = "".join(f'<artist id="{n}"><name>{n}</name></artist>' for n in names)
        return f'<metadata><artist-list count="{len(names)}">{items}</artist-list></metadata>'

    for i, names in enumerate([["a", "b"], ["c"]]):
        with open(os.path.join(scratch, f"x y.{i}.xml"), "w") as f:
            f.write(page(names))
    out = rows(flatten_artists(read_response_files(spark, scratch)), "query", "page", "pos", "name")
    assert out == [("x y", 0, 0, "a"), ("x y", 0, 1, "b"), ("x y", 1, 0, "c")]


def test_response_file_names_are_decoded(spark, scratch):
    import os

    from hitlens.sources import read_response_files

    for q in ("a+b", "c%d", "e f#1"):
        with open(os.path.join(scratch, f"{q}.xml"), "w") as f:
            f.write('<metadata><artist-list count="0"/></metadata>')
    assert sorted(r.query for r in read_response_files(spark, scratch).collect()) == ["a+b", "c%d", "e f#1"]


def test_empty_lists_hide_no_siblings(spark):
    artist = '<relation><artist id="{0}"><name>{0}</name></artist></relation>'
    doc = (
        '<metadata xmlns="http://example.org/ns"><work-list count="1"><work><title> Song </title>'
        '<relation-list target-type="artist"/>'
        f'<relation-list target-type="artist">{artist.format("a1")}<relation/></relation-list>'
        f'<relation-list target-type="artist">{artist.format("a2")}</relation-list>'
        "</work></work-list></metadata>"
    )
    assert rows(flatten_works(docs(spark, doc)), "item", "arid", "title") == [(0, "a1", "Song"), (1, "a2", "Song")]


def test_broken_pages_fail(spark):
    import pytest

    for flatten in (flatten_artists, flatten_works):
        with pytest.raises(Exception):
            flatten(docs(spark, "<metadata><artist-list><artist>")).collect()


def test_response_dump_is_read_by_many_tasks(spark, scratch):
    import os

    from hitlens.sources import read_response_dump

    pages, text = [], "<?xml version='1.0'?>\n<responses>\n"
    for i in range(200):
        query, page = ['a "b" & <c>', "é  x", "", f"q{i}"][i % 4], i // 4
        artists = "".join(f'<artist id="{i}-{j}"><name>N {j}\n&amp; co</name></artist>' for j in range(i % 9))
        pages.append((query, page, i % 9))
        named = query.replace("&", "&amp;").replace("<", "&lt;").replace('"', "&quot;")
        head = f' query="{named}"' if query else ""
        text += f"<response{head}\n page='{page}' >\r\n<metadata><artist-list>{artists}</artist-list></metadata></response>" + "\n" * (i % 3)
    with open(os.path.join(scratch, "dump.xml"), "w", newline="", encoding="utf-8") as f:
        f.write(text + "</responses>\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        docs = read_response_dump(spark, os.path.join(scratch, "dump.xml"))
        assert docs.rdd.getNumPartitions() > 50
        assert sorted((r.query, r.page) for r in docs.collect()) == sorted((q, p) for q, p, _ in pages)
        out = rows(flatten_artists(docs), "query", "page", "pos", "name", "arid")
        assert out == sorted((q, p, j, f"N {j}\n& co", f"{i}-{j}") for i, (q, p, n) in enumerate(pages) for j in range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_response_dump_without_pages(spark, scratch):
    import os

    from hitlens.sources import read_response_dump

    with open(os.path.join(scratch, "d.xml"), "w") as f:
        f.write("<responses>\n</responses>\n")
    assert read_response_dump(spark, scratch).count() == 0
