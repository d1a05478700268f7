"""Fixed tables: genetic code, base mixtures, complements. As values and as small DataFrames."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession

# The standard genetic code with bases in the order T, C, A, G; mixtures of bases; complements.
_BASES = "TCAG"
_AMINOS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
MIXTURES = {"A": "A", "C": "C", "G": "G", "T": "T", "AG": "R", "CT": "Y", "CG": "S", "AT": "W", "GT": "K", "AC": "M", "CGT": "B", "AGT": "D", "ACT": "H", "ACG": "V", "ACGT": "N"}
COMPLEMENT_FROM, COMPLEMENT_TO = "ACGTRYSWKMBVDHN", "TGCAYRWSMKVBHDN"
SIMPLE_FROM, SIMPLE_TO = "ACGT", "TGCA"
CUTOFFS = ("0.010", "0.020", "0.050", "0.100", "0.200", "0.250", "MAX")

CODONS = {"".join(c): a for c, a in zip(product(_BASES, repeat=3), _AMINOS, strict=True)}
BASES_OF = {code: bases for bases, code in MIXTURES.items()}


def mixture_aminos(codon: str) -> str:
    """Aminos, sorted, that a codon of mixtures may stand for."""
    return "".join(sorted({CODONS["".join(c)] for c in product(*(BASES_OF[b] for b in codon))}))


def codon_table(spark: SparkSession) -> DataFrame:
    """codon, amino: the 64 codons and '---'."""
    return spark.createDataFrame([*CODONS.items(), ("---", "-")], "codon string, amino string")


def mixture_codons() -> list[tuple[str, str]]:
    """Every codon of the 15 letters with its aminos; a single dash counts as N."""
    letters = sorted(BASES_OF)
    plain = [("".join(c), mixture_aminos("".join(c))) for c in product(letters, repeat=3)]
    dashed = []
    for at in range(3):
        for pair in product(letters, repeat=2):
            codon = [*pair[:at], "-", *pair[at:]]
            dashed.append(("".join(codon), mixture_aminos("".join("N" if b == "-" else b for b in codon))))
    return plain + dashed


#: Letters of codons as hexadecimal digits; digits and letters that would be taken for one are none.
_DIGITS = "-" + "".join(sorted(BASES_OF))
CODON_DIGITS = (_DIGITS + "EF0123456789", "0123456789ABCDEF" + "x" * 12)


def codon_sets() -> list[str | None]:
    """Aminos of each codon by its number in digits of 16: '-' for '---', none for two dashes."""
    return [mixture_aminos("".join(c).replace("-", "N")) if c.count("-") < 2 else "-" if c == ("-",) * 3 else None for c in product(_DIGITS, repeat=3)]


def mixture_table(spark: SparkSession) -> DataFrame:
    """bases (sorted), code."""
    return spark.createDataFrame(list(MIXTURES.items()), "bases string, code string")


def values(rows: list[tuple], names: str) -> str:
    """The same rows as an SQL table expression."""
    quoted = (", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) for r in rows)
    return f"(VALUES {', '.join(f'({q})' for q in quoted)}) AS t({names})"
