"""Awkward documents: nulls, empty and long texts, copies, repeated rows, and extra columns with clashing names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, size string, of long, fp long, _of int, _gone string, kept string"

LONG = " ".join(f"wort{i % 977} und" for i in range(30_000))
TEXTS = [
    None,
    "",
    " \t\n",
    "Alpha beta gamma delta epsilon.",
    "ALPHA beta gamma delta EPSILON.",
    "Álpha beta",
    "álpha beta",
    LONG,
    LONG,
    LONG + " end",
    "x" * 50_000,
    "one two three",
    "\x00 odd \x1c signs \x7f \U0001f600 漢字",
]


def awkward(spark, empty=False):
    rows = [(i, t, "en", None if i % 3 else "s", 1, i, "big", i, i, i, "g", "k") for i, t in enumerate(TEXTS)]
    rows += [(3, TEXTS[3], "en", "s", 1, 1, "", 1, 1, 1, "", ""), (3, TEXTS[3], "en", "s", 1, 1, "", 1, 1, 1, "", "")]
    rows += [(None, TEXTS[3], None, None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None, None)]
    rows += [(50, "one two three", None, "", 1, 1, "", 1, 1, 1, "", ""), (50, "one two four", None, "", 1, 1, "", 1, 1, 1, "", "")]
    return spark.createDataFrame([] if empty else rows, SCHEMA)
