"""What several test modules use: odd rows, helpers. The fixtures are imported where they are used."""

import re

import pytest

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "size long, fp long, shard int, n long, text_hash long, `start` long, row string")

PROSE = ("the quick brown fox jumps over the lazy dog and runs away from the big grey wolf that lives in the "
         "dark forest near the old stone bridge where nobody ever goes after the sun has set behind the hills ")


def doc(i, text, lang="en", source="s"):
    """A row with extra columns whose names operators use inside."""
    return (i, text, lang, source, None if text is None else len(text), 7, 7, 7, 7, 7, 7, "r")


ODD = [
    doc(1, PROSE * 3), doc(2, PROSE * 3, source=None), doc(3, PROSE * 3 + "fin", source="t"),
    doc(4, None), doc(5, ""), doc(6, " \n\t "), doc(7, "Word"), doc(8, "1234 %% 5678"),
    doc(9, "à la carte, señor — straße ΑΣ ΟΔΟΣ", lang="fr"), doc(10, "x " * 30_000, lang=None),
    doc(11, "same same same same " * 40), doc(None, "no id here at all"), doc(None, "no id here at all"),
    doc(None, None, lang=None, source=None), doc(12, "Twin row"), doc(12, "Twin row"), doc(12, "same id, other text"),
    doc(13, "le chat est sur la table et le chien est dans la maison " * 4, lang="fr", source="t"),
]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, DOC_SCHEMA)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def as_dict(df):
    return {r.doc_id: r for r in df.collect()}
