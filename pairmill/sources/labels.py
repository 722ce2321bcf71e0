"""Hand-labelled word pairs: the built-in list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.functions.text import canonical_pair
from pairmill.operators.evaluation import LABEL_DECADE, label_set

# The evaluation is defined on exactly these pairs. Repeats, capitals,
# spelling and the self-pair belong to the list.
RELATED = """
tiger jaguar, tiger feline, closet clothes, planet sun, hotel reservation,
planet constellation, credit card, stock market, psychology psychiatry, planet moon,
planet galaxy, bank money, physics proton, vodka brandy, war troops, Harvard Yale,
news report, psychology Freud, money wealth, man woman, FBI investigation,
network hardware, nature environment, seafood food, weather forecast,
championship tournament, law lawyer, money dollar, calculation computation,
planet star, Jerusalem Israel, vodka gin, money bank, computer software,
murder manslaughter, king queen, OPEC oil, Maradona football, mile kilometer,
seafood lobster, furnace stove, environment ecology, boy lad, asylum madhouse,
street avenue, car automobile, gem jewel, type kind, magician wizard, football soccer,
money currency, money cash, coast shore, money cash, dollar buck, journey voyage,
midday noon, tiger tiger
"""

# Fixed values, as above.
UNRELATED = """
king cabbage, professor cucumber, chord smile, noon string, rooster voyage,
sugar approach, stock jaguar, stock life, monk slave, lad wizard, delay racism,
stock CD, drink ear, stock phone, holy sex, production hike, precedent group, stock egg,
energy secretary, month hotel, forest graveyard, cup substance, possibility girl,
cemetery woodland, glass magician, cup entity, Wednesday news, direction combination,
reason hypertension, sign recess, problem airport, cup article, Arafat Jackson,
precedent collection, volunteer motto, listing proximity, opera industry, drink mother,
crane implement, line insurance, announcement effort, precedent cognition, media gain,
cup artifact, Mars water, peace insurance, viewer serial, president medal,
prejudice recognition, drink car, shore woodland, coast forest, century nation,
practice instituton, governor interview, money operation, delay news,
morality importance, announcement production, five month, school center,
experience music, seven series, report gain, music project, cup object,
atmosphere landscape, minority peace, peace atmosphere, morality marriage, stock live,
population development, architecture century, precedent information,
situation isolation, media trading, profit warning, chance credibility,
theater history, day summer, development issue
"""


def word_pairs(text: str) -> list[tuple[str, str]]:
    """Comma-separated `a b` entries as tuples."""
    return [tuple(entry.split()) for entry in text.replace("\n", " ").split(",")]


def builtin_labels(spark: SparkSession, normalize: bool = False) -> DataFrame:
    """`decade, w1, w2, related`: the built-in list, each pair once.

    By default words keep their case, so a label with a capital never meets a counted
    (lower-case) word; `normalize` folds it.
    """

    def canonical(entries):
        w1, w2 = canonical_pair(F.col("a"), F.col("b"), lowercase=normalize)
        rows = spark.createDataFrame(entries, "a string, b string")
        return rows.select(w1.alias("w1"), w2.alias("w2"))

    labels = label_set(canonical(word_pairs(RELATED)), canonical(word_pairs(UNRELATED)))
    return labels.select(F.lit(LABEL_DECADE).alias("decade"), "w1", "w2", "related")
