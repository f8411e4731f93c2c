"""Small inputs that hold the awkward cases of every operator."""

import random

import duckdb

SMALL = "/root/testdata/sf0.001"

#: Names that operators use inside or return; documents may carry such columns too.
CLASHING = {"kept": "x", "size": "y", "key": "z", "fingerprint": "f", "row_id": "r", "text_key": "t", "rule": "u", "words": "w"}


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(v) for c, v in CLASHING.items()})


def awkward_texts(seed=7):
    rng = random.Random(seed)
    words = "alpha Beta gamma Délta eps ÉTÉ zeta #tag a|b the The of und für ñu 123 x".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    line = "This very line is long enough to count as a shared key 0123456789"
    base = prose(120)
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "a b c", "\u2003wide\u00a0blank ", base, base, base.replace("gamma", "omega", 1),
             prose(3000), "x" * 5000, "ab " * 400, prose(19), prose(20), f"{line}\n{prose(8)}\n{line}", f"  {line.upper()}\t\n{prose(30)}",
             f"{prose(9)}\n{line}", f"{line}\nq", f"z\n{line} ", f"{line}", "é" * 45 + "\n" + prose(10), "\n\n\n", "tail\n"]
    return texts + [prose(rng.randrange(1, 200)) for _ in range(40)]


def awkward_documents(spark):
    """Null, empty and very long texts, ties, repeated rows, a null id and foreign columns."""
    texts = awkward_texts()
    rows = [(i, t, "en", "src0", None) for i, t in enumerate(texts)]
    rows += [(6, texts[6], "en", "src0", None), (6, texts[6], "en", "src0", None), (None, texts[10], None, None, None), (-5, texts[9], "de", "s", 1)]
    return with_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def small_documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def duck(**frames):
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name, frame)
    return con


def as_rows(df, *columns):
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=key)


def against_sql(df, sql, **frames):
    """Rows of ``df`` and of the DuckDB query over the given pandas frames, in like order."""
    con = duck(**frames)
    got = con.sql(sql)
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    return as_rows(df, *got.columns), sorted(got.fetchall(), key=key)
