"""Small tables and brute-force versions shared by the operator tests."""
from __future__ import annotations

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, fp long, row long, seq long, grp long, "
        "key string, rep long, shard int, first long, items string, entities string, component_id long")
EXTRA = (7, 7, 7, 7, "k", 7, 7, 7, "i", "e", 7)
LONG = "the long one goes on and on with a mail long.tail@example.com in it . " * 9000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the hunter.", "en"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the hunter.", "en"),
    (3, None, "en"), (4, "", None), (5, "   \n\t ", "en"), (6, "12345 !!! ---", None),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund und läuft davon.", "de"),
    (8, "word", "en"), (9, LONG, "en"), (10, LONG, None), (10, LONG, None),
    (None, "a row without id says: write to a.b@example.org or call +1 (212) 555-0187", None),
    (None, None, None), (11, "Straße ÄÖÜ İstanbul 日本語テキスト emoji 😀 done", "de"),
]


def docs(spark, rows=ROWS):
    """Documents with nulls, empty, odd, long, equal and repeated rows, and extra columns with clashing names."""
    return spark.createDataFrame([(i, t, g, None, None if t is None else len(t), *EXTRA) for i, t, g in rows], DOCS)


def key(row):
    return tuple((v is not None, v) for v in row)
