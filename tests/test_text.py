"""Name case and standardisation on hand-written names."""

import pytest
from pyspark.sql import functions as F

from rosterflow.functions import text as tx

CASES = [
    ("KEITH", "Keith"), ("LEIGH-WILLIAMS", "Leigh-Williams"), ("MCCARTHY", "McCarthy"),
    ("O'CALLAGHAN", "O'Callaghan"), ("ST. JOHN", "St. John"), ("VON STREIT", "von Streit"),
    ("VAN DYKE", "van Dyke"), ("AP LLWYD DAFYDD", "ap Llwyd Dafydd"), ("MACKENZIE", "Mackenzie"),
    ("MACHIN", "Machin"), ("MACMURDO", "MacMurdo"), ("DE LA HOYA", "de La Hoya"),
    ("HENRY VIII", "Henry VIII"), ("JJ ABRAMS", "JJ Abrams"), ("MR SMITH", "Mr Smith"),
    ("JOHN'S", "John's"), ("JUAN Y MARIA", "Juan y Maria"), ("JOHN SMITH PHD", "John Smith PhD"),
    ("AL QAEDA", "al Qaeda"), ("BEN GURION", "ben Gurion"), ("mary-kate", "Mary-Kate"),
    ("", ""), (None, None),
]


def _apply(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_namecase_cases(spark):
    got = _apply(spark, [c[0] for c in CASES], tx.namecase)
    assert got == [c[1] for c in CASES]


def test_namecase_lazy_keeps_mixed_case(spark):
    assert _apply(spark, ["McDonald-Smith", "SMITH"], lambda c: tx.namecase(c, lazy=True)) == \
        ["McDonald-Smith", "Smith"]


def test_namecase_options_are_per_call(spark):
    # Street formatting turns the Spanish option off; names keep it on.
    assert _apply(spark, ["CALLE LA PAZ"], lambda c: tx.namecase(c, spanish=False)) == ["Calle la Paz"]
    assert _apply(spark, ["CALLE LA PAZ"], tx.namecase) == ["Calle La Paz"]


def test_std_fields(spark):
    assert _apply(spark, ["FT. CAMPBELL", "mt juliet", "LA VERGNE"], tx.std_city) == \
        ["Fort Campbell", "Mount Juliet", "La Vergne"]
    assert _apply(spark, ["12  MAIN ST.", "4 O'BRIEN CT"], tx.std_street) == ["12 Main St", "4 OBrien Ct"]
    assert _apply(spark, ["##SMITH", "###JONES", "DOE"], lambda c: tx.std_name(c, last_name=True)) == \
        ["##Smith", "##Jones", "Doe"]
    assert _apply(spark, ["37211-1234", "37211"], tx.std_zip) == ["37211", "37211"]
    assert _apply(spark, ["t.n.", "Tn"], tx.std_state) == ["TN", "TN"]


def test_scrub_and_trim(spark):
    assert _apply(spark, ["José\r\n"], tx.scrub_ascii) == ["Jos\r\n"]
    assert _apply(spark, ['  say "hi"\r\n '], lambda c: tx.trim_fields(c, quote_to_apostrophe=True)) == ["say 'hi'"]
