"""Units of torque and current: factors, usual spellings, and a weighted edit distance between spellings."""

from __future__ import annotations

# Unit -> (quantity, factor to the base unit, spellings)
POUND_FORCE, INCH, FOOT, KILOGRAM_FORCE = 4.4482216152605, 0.0254, 12 * 0.0254, 9.80665
UNITS = {
    "N·m": ("torque", 1.0, ["N·m", "Nm", "newton metre", "newton meter", "newton metres", "newtonmeter", "牛米", "牛顿米"]),
    "mN·m": ("torque", 1e-3, ["mN·m", "mNm", "millinewton metre", "millinewton meter", "millinewton metres", "millinewtonmeter", "毫牛米", "毫牛顿米"]),
    "N·cm": ("torque", 1e-2, ["N·cm", "Ncm", "newton centimetre", "newton centimeter", "newton centimetres", "newtonzentimeter", "牛厘米", "牛顿厘米"]),
    "kgf·cm": ("torque", KILOGRAM_FORCE * 0.01, ["kgf·cm", "kg·cm", "kp·cm", "kilogram-force centimetre", "kilogram-force centimetres", "kilopondzentimeter", "公斤力厘米", "千克力厘米"]),
    "kgf·m": ("torque", KILOGRAM_FORCE, ["kgf·m", "kilogram-force metre", "kilogram-force metres", "kilopondmeter", "公斤力米"]),
    "lbf·in": ("torque", POUND_FORCE * INCH, ["lbf·in", "in·lbf", "lb·in", "in·lb", "pound-force inch", "pound-force inches", "inch pounds", "磅力英寸"]),
    "lbf·ft": ("torque", POUND_FORCE * FOOT, ["lbf·ft", "ft·lbf", "lb·ft", "ft·lb", "pound-force foot", "pound-force feet", "foot pounds", "磅力英尺"]),
    "ozf·in": ("torque", POUND_FORCE / 16 * INCH, ["ozf·in", "in·ozf", "oz·in", "in·oz", "ounce-force inch", "ounce-force inches", "盎司力英寸"]),
    "A": ("current", 1.0, ["A", "amp", "amps", "ampere", "amperes", "安培"]),
    "mA": ("current", 1e-3, ["mA", "milliamp", "milliamps", "mAmp", "milliampere", "milliamperes", "毫安", "毫安培"]),
    "cA": ("current", 1e-2, ["cA", "centiamp", "centiamps", "centiampere", "hundredths of an ampere", "Hundertstel Ampere", "厘安", "厘安培"]),
    "µA": ("current", 1e-6, ["µA", "μA", "uA", "microamp", "microamps", "microampere", "microamperes", "mikroampere", "微安", "微安培"]),
}
BASE = {"torque": "N·m", "current": "A"}

_SEPARATORS, _VOWELS = " .·*-_/", "aeiouäöü"


def _substitute(a: str, b: str) -> float:
    if a == b:
        return 0.0
    if a in _SEPARATORS and b in _SEPARATORS:
        return 0.02
    if a.lower() == b.lower():
        return 0.05
    return 0.6 if a.lower() in _VOWELS and b.lower() in _VOWELS else 1.0


def spelling_distance(a: str, b: str) -> float:
    """Edit distance in which separators and letter case cost little, vowels less than consonants."""
    gap = lambda c: 0.05 if c in _SEPARATORS else 0.6 if c in "es" else 1.0
    row = [0.0]
    for y in b:
        row.append(row[-1] + gap(y))
    for x in a:
        new = [row[0] + gap(x)]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + gap(x), new[j - 1] + gap(y), row[j - 1] + _substitute(x, y)))
        row = new
    return row[-1]
