"""Colours for a position t in [0, 1]: stops are computed once, interpolation runs as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The gradient's colours and the values they stand at.
GRADIENT_COLORS = ("#3B4CC0", "#7B9FF9", "#C9D7F0", "#F7D4CF", "#F08A6C", "#B40426")
GRADIENT_VALUES = (1, 10, 20, 30, 40, 60)

# End colours of the diverging map (sRGB 0-1), its stop count and its table size.
DIVERGING_ENDS = ((0.2298057, 0.298717966, 0.753683153), (0.705673158, 0.01555616, 0.150232812))
DIVERGING_STOPS = 33
DIVERGING_LEVELS = 256

# sRGB to XYZ for the D65 white point, and that white point.
RGB_TO_XYZ = (
    (0.4124564, 0.3575761, 0.1804375),
    (0.2126729, 0.7151522, 0.0721750),
    (0.0193339, 0.1191920, 0.9503041),
)
WHITE = (0.95047, 1.0, 1.08883)

Stop = tuple[float, float, float, float]


def hex_to_rgb(color: str) -> tuple[int, int, int]:
    return tuple(int(color[i : i + 2], 16) for i in (1, 3, 5))


def _invert(m: Sequence[Sequence[float]]) -> list[list[float]]:
    (a, b, c), (d, e, f), (g, h, i) = m
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    adjugate = (
        (e * i - f * h, c * h - b * i, b * f - c * e),
        (f * g - d * i, a * i - c * g, c * d - a * f),
        (d * h - e * g, b * g - a * h, a * e - b * d),
    )
    return [[x / det for x in row] for row in adjugate]


XYZ_TO_RGB = _invert(RGB_TO_XYZ)


def _rgb_to_lab(rgb: Sequence[float]) -> tuple[float, float, float]:
    """CIE Lab of an sRGB colour given in 0-255."""
    linear = [c / 12.92 if c <= 0.04045 else ((c + 0.055) / 1.055) ** 2.4 for c in (x / 255 for x in rgb)]
    xyz = [sum(k * c for k, c in zip(row, linear)) for row in RGB_TO_XYZ]
    delta = 6 / 29
    fx, fy, fz = (
        r ** (1 / 3) if r > delta**3 else r / (3 * delta**2) + 4 / 29 for r in (v / w for v, w in zip(xyz, WHITE))
    )
    return 116 * fy - 16, 500 * (fx - fy), 200 * (fy - fz)


def _lab_to_rgb(lab: Sequence[float]) -> tuple[float, float, float]:
    delta = 6 / 29
    fy = (lab[0] + 16) / 116
    f = (fy + lab[1] / 500, fy, fy - lab[2] / 200)
    xyz = [w * (v**3 if v > delta else 3 * delta**2 * (v - 4 / 29)) for v, w in zip(f, WHITE)]
    linear = [sum(k * c for k, c in zip(row, xyz)) for row in XYZ_TO_RGB]
    return tuple(
        255 * (12.92 * c if c <= 0.0031308 else 1.055 * c ** (1 / 2.4) - 0.055) for c in (max(x, 0.0) for x in linear)
    )


def diverging_stops() -> list[Stop]:
    """``t, r, g, b`` (0-255) of the cool-to-warm map, by its published rule.

    Both ends go to polar Lab (magnitude, saturation, hue); each half runs straight to white-grey, with the hue of
    the grey turned so that the path stays perceptually even (K. Moreland, "Diverging Color Maps for Scientific
    Visualization", 2009).
    """

    def to_polar(rgb):
        light, a, b = _rgb_to_lab(rgb)
        m = math.sqrt(light * light + a * a + b * b)
        return m, math.acos(light / m), math.atan2(b, a)

    def turned(color, m_grey):
        m, s, h = color
        if m >= m_grey:
            return h
        spin = s * math.sqrt(m_grey * m_grey - m * m) / (m * math.sin(s))
        return h + spin if h > -math.pi / 3 else h - spin

    left, right = (to_polar([255 * c for c in end]) for end in DIVERGING_ENDS)
    m_grey = max(left[0], right[0], 88.0)
    stops = []
    for i in range(DIVERGING_STOPS):
        t = i / (DIVERGING_STOPS - 1)
        end, w = (left, 1 - 2 * t) if t < 0.5 else (right, 2 * t - 1)
        grey = (m_grey, 0.0, turned(end, m_grey))
        m, s, h = (w * e + (1 - w) * g for e, g in zip(end, grey))
        lab = (m * math.cos(s), m * math.sin(s) * math.cos(h), m * math.sin(s) * math.sin(h))
        stops.append((t, *_lab_to_rgb(lab)))
    return stops


def gradient_stops(
    colors: Sequence[str] = GRADIENT_COLORS, values: Sequence[float] = GRADIENT_VALUES
) -> list[Stop]:
    """``t, r, g, b`` (0-255) with the values brought to [0, 1]."""
    low, high = min(values), max(values)
    return [((v - low) / (high - low), *map(float, hex_to_rgb(c))) for c, v in zip(colors, values)]


def segment_of(t: Column, stops: Sequence[Stop]) -> Column:
    """Number of the stretch between two stops that holds ``t``, from 1; a stop belongs to the stretch below it."""
    passed = sum((F.when(t > F.lit(at), 1).otherwise(0) for at, *_ in stops[1:-1]), F.lit(1))
    return F.when(t.isNotNull(), passed)


def interpolate(t: Column, segment: Column, stops: Sequence[Stop], channel: int) -> Column:
    """Straight line between the two stops around ``t``; ``channel`` 1-3."""

    def pick(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), segment)

    pairs = list(zip(stops, stops[1:]))
    share = (t - pick([a[0] for a, _ in pairs])) / pick([b[0] - a[0] for a, b in pairs])
    return pick([a[channel] for a, _ in pairs]) + share * pick([b[channel] - a[channel] for a, b in pairs])


def rgb_hex(channels: Sequence[Column]) -> Column:
    """``#RRGGBB`` from three channels, cut to 0-255; NULL when the first is."""
    whole = [F.floor(F.least(F.greatest(c, F.lit(0.0)), F.lit(255.0)) + F.lit(0.5)) for c in channels]
    return F.when(channels[0].isNotNull(), F.concat(F.lit("#"), *[F.lpad(F.hex(c), 2, "0") for c in whole]))


def gradient_rgb(t: str, segment: str) -> list[Column]:
    """Red, green and blue, each on a straight line between the gradient's stops."""
    return [interpolate(F.col(t), F.col(segment), gradient_stops(), c) for c in (1, 2, 3)]


def gradient_lab(t: str, segment: str) -> list[Column]:
    """CIE Lab channels, each on a straight line between the gradient's stops."""
    stops = [(at, *_rgb_to_lab(rgb)) for at, *rgb in gradient_stops()]
    return [interpolate(F.col(t), F.col(segment), stops, c) for c in (1, 2, 3)]


def lab_axes(light: str, a: str, b: str) -> list[Column]:
    fy = (F.col(light) + F.lit(16.0)) / F.lit(116.0)
    return [fy + F.col(a) / F.lit(500.0), fy, fy - F.col(b) / F.lit(200.0)]


def axes_to_xyz(axes: Sequence[str]) -> list[Column]:
    knee = 6 / 29
    return [
        F.when(F.col(f) > F.lit(knee), F.col(f) * F.col(f) * F.col(f)).otherwise(
            (F.col(f) - F.lit(4 / 29)) * F.lit(3 * knee**2)
        )
        * F.lit(white)
        for f, white in zip(axes, WHITE)
    ]


def xyz_to_linear(xyz: Sequence[str]) -> list[Column]:
    x, y, z = (F.col(c) for c in xyz)
    return [x * F.lit(p) + y * F.lit(q) + z * F.lit(r) for p, q, r in XYZ_TO_RGB]


def linear_to_rgb(linear: Sequence[str]) -> list[Column]:
    channels = []
    for c in (F.col(name) for name in linear):
        curve = F.pow(c, F.lit(1 / 2.4)) * F.lit(1.055) - F.lit(0.055)
        channels.append(F.when(c > F.lit(0.0031308), curve).otherwise(c * F.lit(12.92)) * F.lit(255.0))
    return channels


def diverging_table() -> list[str]:
    """The diverging map as ``DIVERGING_LEVELS`` colours, each on the line between its two stops."""
    stops = diverging_stops()
    table = []
    for level in range(DIVERGING_LEVELS):
        place = level / (DIVERGING_LEVELS - 1) * (DIVERGING_STOPS - 1)
        at = min(int(place), DIVERGING_STOPS - 2)
        rgb = [low + (place - at) * (high - low) for low, high in zip(stops[at][1:], stops[at + 1][1:])]
        table.append("#" + "".join(f"{math.floor(min(max(c, 0.0), 255.0) + 0.5):02X}" for c in rgb))
    return table


def diverging_color(t: Column) -> Column:
    """Entry of the table, which is one text constant cut to its seven characters."""
    last = F.lit((DIVERGING_LEVELS - 1) / DIVERGING_LEVELS)
    level = F.floor(F.when(t >= 1, last).otherwise(t) * F.lit(float(DIVERGING_LEVELS))).cast("int")
    return F.lit("".join(diverging_table())).substr(level * 7 + 1, F.lit(7))
