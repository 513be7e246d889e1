"""Tables whose extra columns have the names that the operators use for their own."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ruleweave.llm import decontamination, mixing, quality_rules, simhash_dedup

OWN = sorted({n for p in Path(quality_rules.__file__).parent.glob("*.py") for n in re.findall(r"_rw_\w+", p.read_text())})
LONG = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, LONG, "en", "a"), (2, LONG, "en", "a"), (3, "item " + " ".join(f"quiz{i}" for i in range(59)), "de", "b"),
        (4, None, None, None), (None, "x " * 80, "fr", "b"), (6, "", "", "c"), (6, LONG.upper(), "en", "c")]
SCHEMA = "doc_id long, text string, lang string, source string"
STAGES = {
    "quality": lambda d, s: quality_rules.keep(d, s.createDataFrame([(1, 1)], "doc_id long, quality int")),
    "near": lambda d, s: simhash_dedup.one_of_each_group(d, shingle=3, max_bits=2),
    "leaks": lambda d, s: decontamination.remove_contaminated(
        d, s.createDataFrame([(1, " ".join(f"quiz{i}" for i in range(30)))], "item_id long, text string")),
    "mix": lambda d, s: mixing.mix(d, weights={"a": 1.0, "b": 2.0, "": 1.0, "c": 1.0}, copy_col="n", rate_col="r").drop("n", "r"),
}


@pytest.mark.parametrize("name", STAGES)
def test_columns_of_any_name_keep_their_values(spark, name):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    extra = [*OWN, "_RW_Upper", "aside_0"]
    wide = plain.select("*", *[F.concat_ws("/", F.lit(c), F.col("doc_id")).alias(c) for c in extra])
    got = STAGES[name](wide, spark)
    assert got.columns == wide.columns
    rows = got.collect()
    assert rows and all(r[c] == (c if r.doc_id is None else f"{c}/{r.doc_id}") for r in rows for c in extra)
    want = [tuple(r) for r in STAGES[name](plain, spark).collect()]
    assert sorted(map(repr, (tuple(r)[:4] for r in rows))) == sorted(map(repr, want))
    assert STAGES[name](wide.limit(0), spark).count() == 0


def test_columns_in_use_may_have_such_names(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumnsRenamed({"doc_id": "_rw_id", "text": "_rw_key"})
    got = simhash_dedup.one_of_each_group(docs, id_col="_rw_id", text_col="_rw_key")
    assert got.columns == docs.columns and {r._rw_id for r in got.collect()} == {1, 3, None, 4}
