"""A table with everything that may go wrong, and its variants."""

import random

from pyspark.sql import functions as F

# Names that operators use inside, and names of their results.
CLASHING = [
    "id", "digest", "salt", "variant", "keep_id", "kept", "keys", "n", "fp", "first", "root", "component_id", "u", "v", "spans",
    "span", "shard", "_line_id", "_line_keys", "_suffix_id", "_language", "_gone", "row", "length", "bucket", "number",
    "n_lines", "n_dropped", "n_bytes", "n_removed", "host", "path", "y", "p", "html", "_id", "_text", "words",
]


def texts():
    r = random.Random(7)
    words = ["stone", "river", "Über", "maison", "llano", "keeps", "turning", "é", "x1", "and", "the", "of"]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = prose(40) + "."
    shared = "This very line stands in many documents, as lines do."
    rows = [
        (1, None), (2, ""), (3, " \n\t\r "), (4, "same text  here, as it is"), (4, "same text  here, as it is"),
        (5, "same text\there, as it is"), (6, "SAME TEXT HERE, AS IT IS"), (None, "same text  here, as it is"),
        (9, shared + "\nown line of nine that is long\n" + passage), (8, passage + "\n  " + shared.upper() + "  \n" + shared),
        (7, "\n".join([shared, shared, "short", "short", ""])), (11, "short\n" + prose(25) + passage + prose(5)),
        (12, prose(3000)), (13, "é" * 3000), (14, "ab" * 20000), (15, "word " * 4000), (16, prose(300) + " <|endoftext|> " + prose(3)),
        (17, "12345 67890 !!! ???"), (18, "日本語のテキスト。" * 30), (19, "\x1c\x85\xa0 　x\x00y" * 20), (2**40, prose(120)),
    ]
    base = prose(400).split()
    for n in range(20, 40):  # near copies
        own = base[:]
        own[r.randrange(400)] = f"new{n}"
        rows.append((n, " ".join(own)))
    return rows


def docs(spark, rows=None, clashing=True):
    rows = texts() if rows is None else rows
    full = [(i, t, "en" if n % 3 else None, f"src{n % 2}", len(t or "")) for n, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df = df.repartition(5, F.rand(3))
    return df.withColumns({c: F.lit(f"clash {c}") for c in CLASHING}) if clashing else df


def outer(i):
    return None if i == 2**63 - 1 else i


def brute_id(i):
    return 2**63 - 1 if i is None else i
