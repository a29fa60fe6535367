"""Rows with every oddity, as fixtures."""

import pytest

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))


def rows():
    """Ids and texts with nulls, blanks, long texts, ties, repeated rows."""
    sentences = [
        "The cat sat on the mat and looked at the dog that slept by the door of the house.",
        "Der Hund schläft vor der Tür und die Katze sieht ihm zu, während es draußen regnet.",
        "Le chat était assis près de la porte et regardait le chien qui dormait dans la maison.",
    ]
    out = [
        (1, sentences[0]), (2, sentences[1]), (3, sentences[2]), (4, None), (5, ""), (6, " \n\t "), (7, LONG),
        (8, sentences[0]), (8, sentences[0]), (9, sentences[0].upper()), (None, sentences[0]), (None, None),
        (10, f"{PASSAGE} own words of ten"), (11, f"start of eleven {PASSAGE}"), (12, f"{PASSAGE} {PASSAGE}"),
        (13, "\n".join([sentences[0], "  THE CAT SAT on the mat  ", "short", "", sentences[1], sentences[1]])),
        (14, "\n\n\n"), (15, "1234 5678 !!"), (16, "été Été ÉTÉ ẞ 数 据 😀"), (17, "a\x0bb\x0cc\rd\te f"),
        (18, "one two"), (19, "### *** $$$ %%% &&& ||| <<< >>> ### *** ok"),
        (20, " ".join(["again and again we say so"] * 40)), (21, sentences[0] + " Nearly."), (22, LONG + " tail"),
    ]
    return out


@pytest.fixture(scope="session")
def docs(spark):
    """The rows with further columns that are named like the operators' own."""
    named = [
        (i, t, "en" if k % 2 else None, f"src{k % 4}" if k % 5 else None, None if t is None else len(t), k, "x", 1.5, [k])
        for k, (i, t) in enumerate(rows())
    ]
    return spark.createDataFrame(named, SCHEMA).repartition(3)


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row int, size string, score double, rest array<int>"
)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_set(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)
