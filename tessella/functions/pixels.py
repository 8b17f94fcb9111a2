"""Pixel expressions: quantising, premultiplied colour, ink and paper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Half an 8-bit step: alpha at most this is blank.
BLANK = 0.5 / 255
OPAQUE = 1e-6
INK, INK_LEAST, PAPER, CHROMA = 110, 128, 250, 10


def quantise(v: Column) -> Column:
    """To 0..255, half to even."""
    return F.rint(F.least(F.greatest(v, F.lit(0.0)), F.lit(255.0))).cast("int")


def premultiply(c: Column, a8: Column) -> Column:
    """8-bit colour and alpha to colour in 0..1 times alpha in 0..1."""
    return c * a8 / 65025.0


def finish_alpha(a: Column) -> Column:
    return quantise(a * 255)


def finish_colour(premultiplied: Column, a: Column) -> Column:
    """8-bit colour from colour (0..255) times alpha; black where alpha is zero."""
    return F.when(a > 0, quantise(premultiplied / F.when(a > 0, a))).otherwise(0)


def dark(r: Column, g: Column, b: Column) -> Column:
    return F.greatest(r, g, b) < INK


def ink(r: Column, g: Column, b: Column) -> Column:
    return F.least(r, g, b) < INK_LEAST


def paper(r: Column, g: Column, b: Column, least: int = PAPER) -> Column:
    return F.least(r, g, b) >= least


def chroma(r: Column, g: Column, b: Column) -> Column:
    return (F.greatest(r, g, b) - F.least(r, g, b)) > CHROMA


def through_palette(indices: DataFrame, palette: DataFrame, sheet: str = "sheet", index: str = "idx") -> DataFrame:
    """Pixels with the colours that their sheet's palette has for their index; an index it lacks gives no pixel."""
    return indices.join(palette, [sheet, index])
