from __future__ import annotations

import random

import duckdb
import pytest

from tests.conftest import SF_DIR

DOC_SCHEMA = "doc_id long, text string, source string, score double, row string, n_words int, bits long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ly", "ing"]) for _ in range(n))


ODD_TEXTS = {
    1: "",
    2: None,
    3: "   \n\t ",
    4: "one",
    5: "One two",
    6: prose(400, 1),
    7: prose(400, 1),  # a copy
    8: prose(400, 1).upper(),  # a copy in capitals
    9: prose(200, 2) + " " + prose(60, 3),
    10: prose(60, 3) + "\n" + prose(200, 4),
    11: "née élève ß 日本語 🙂 " * 30,
    12: "x" * 3000,
    13: "same line\nsame line\nother\n\n\nsame line",
    14: prose(30000, 5),  # very long
    15: "De " * 300,
}


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank, very long and repeated rows, columns with clashing names."""
    rows = [(k, t, f"s{k % 3}" if k % 5 else None, 9.0, "r", -1, 7) for k, t in ODD_TEXTS.items()]
    rows.append(rows[5])  # a repeated row
    rows.append((None, prose(100, 6), "s1", None, None, None, None))
    rows.append((None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text, source) of the whole small table."""
    return (
        duckdb.connect()
        .execute(f"SELECT doc_id, text, source FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id")
        .fetchall()
    )


def ids_and_texts() -> list[tuple]:
    return [(r[0], r[1]) for r in odd_rows()]
