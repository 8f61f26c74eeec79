"""Awkward tables that every operator must handle, and small plain-Python definitions."""
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like those the operators use inside.
CLASH = "c long, n string, h string, k int, a int, b int, part int, node long, evidence double, site_n int, position long, ids string, class string"


def documents(spark, rows, clash=False):
    """rows: (doc_id, text, lang, source)."""
    data = [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows]
    df = spark.createDataFrame(data, SCHEMA)
    if clash:
        df = df.selectExpr("*", *[f"cast(null as {x.split()[1]}) as {x.split()[0]}" for x in CLASH.split(", ")])
    return df


def awkward_rows():
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(60)]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base = text(80)
    rows = [(1, None, "en", "s1"), (2, "", "en", "s1"), (3, "  \n\t", None, "s1"), (4, "one two", "en", None),
            (5, "One two", "en", "s1"), (6, base, "de", "s2"), (7, base.replace(" ", "\n"), "de", "s2"), (7, base, "de", "s2"),
            (8, base + " tail", "de", "s2"), (9, "x" * 50_000, "en", "s2"), (10, text(6000), "en", "s2"),
            (11, "é漢🙂 É ß \x0b mixed\x0cseparators\r\n", "fr", "s3"), (12, text(30) + " " + passage, "fr", "s3"),
            (13, passage + " " + text(20), "fr", "s3"), (None, "no id at all", "en", "s1"), (None, None, None, None),
            (14, "same words " * 50, "es", "s1"), (15, base, "de", "s2")]
    rows.append(rows[5])  # a repeated row
    return rows


def words(text, lower=False):
    if lower:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")
