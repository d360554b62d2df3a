from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that operators use for their own ends, as extra columns of the documents.
CLASHING = ["fp", "component_id", "size", "hits", "owner", "kept", "row", "spans", "key", "taken"]
SF = "/root/testdata/sf0.001"


def write(spark, folder: str, documents, benchmark=(), labels=(), conversations=(), clashing=False) -> str:
    df = spark.createDataFrame(documents, DOCUMENTS)
    if clashing:
        for i, name in enumerate(CLASHING):
            df = df.selectExpr("*", f"'x{i}' AS `{name}`" if i % 2 else f"{i} AS `{name}`")
    df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(benchmark), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(conversations), "conv_id bigint, turn int, role string, text string").write.parquet(
        f"{folder}/conversations.parquet"
    )
    return folder


def given(spark) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*[c.split()[0] for c in DOCUMENTS.split(", ")]).collect()]


def odd_documents(spark) -> list[tuple]:
    """Given documents with nulls, empty, blank, very long and repeated ones among them."""
    rng = random.Random(7)
    rows = given(spark)
    passage = " ".join(f"w{rng.randrange(50)}" for _ in range(60))
    secret = 'api_key = "abcdef0123456789abcdef01" token=abc AKIA' + "Z" * 18
    texts = [
        None, "", " \t\n", "one", "two words", "ß € 漢字 " + secret, secret + "\n" + secret, "#" * 500, "a " * 400,
        passage, "x " + passage + " y", passage + " " + passage, "Aa1" * 30, "token=token: abcdefgh", "ＡＢＣ １２３",
        " ".join(f"w{rng.randrange(40)}" for _ in range(40_000)),  # very long, with many repeats
        "word " * 30_000, "\U0001f600 emoji ퟿ ok " * 20,
    ]
    rows += [(10_000 + i, t, ["en", None, "xx"][i % 3], ["src0", None, "s"][i % 3], len(t) if t else None) for i, t in enumerate(texts)]
    rows += [(None, passage + " no id", "en", "src0", 1), (None, None, None, None, None)]
    rows += [rows[0], rows[0], rows[-5]]  # repeated rows
    for i in range(120):  # copies and near copies
        w = rows[3][1].split(" ")
        if i % 2:
            w[rng.randrange(len(w))] = f"edit{i % 30}"
        rows.append((20_000 + i, " ".join(w), "en", "src1", 5))
    return rows


@pytest.fixture(scope="session")
def small(spark, tmp_path_factory):
    """Folder of given tables."""
    return SF


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, None), (901, ""), (902, "two words"), (903, "two words"), (None, items[0][1]), (items[1][0], items[1][1]), (904, "!!")]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    labels += [(None, 1, 0), (labels[0][0], 0, 1), (10_001, None, None)]
    talk = [
        (1, 0, "user", "How do I build it?\nI have tried make."), (1, 1, "assistant", "> I have tried make.\nTry again with cmake."),
        (1, 2, "user", "> > I have  tried MAKE.\n> Try again with cmake.\nThat works, thank you."),
        (1, 3, "assistant", "> How do I build it? I have tried make.\nSee the manual for that."),
        (1, 2, "user", "> > I have  tried MAKE.\n> Try again with cmake.\nThat works, thank you."),
        (None, 1, "user", "> Try again with cmake."), (2, None, "user", None), (2, 0, None, ""), (2, 1, "user", ">>>"),
    ]
    talk += [(3, i, "user", "> the same quoted line again\nthe same quoted line again") for i in range(3000)]
    return write(spark, str(tmp_path_factory.mktemp("odd")), odd_documents(spark), items, labels, talk, clashing=True)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write(spark, str(tmp_path_factory.mktemp("empty")), [])
