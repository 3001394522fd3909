"""Measurement units and their spellings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# fixed values: canonical unit, then the other spellings of it (looked up in lower case)
SPELLINGS = {
    "µA": ["uA", "μA", "microamp", "micro-amp", "ua"],
    "mA": ["milliamp", "milli-amp", "ma"],
    "A": ["amp", "amps", "ampere"],
    "µV": ["uV", "μV", "microvolt"],
    "mV": ["millivolt", "mv"],
    "V": ["volt", "volts", "Volt"],
    "kV": ["kilovolt", "kv"],
    "µW": ["uW", "μW", "microwatt"],
    "mW": ["milliwatt", "mw"],
    "W": ["watt", "watts"],
    "kW": ["kilowatt", "kw"],
    "µF": ["uF", "μF", "microfarad"],
    "nF": ["nanofarad", "nf"],
    "pF": ["picofarad", "pf"],
    "µH": ["uH", "μH", "microhenry"],
    "mH": ["millihenry", "mh"],
    "nH": ["nanohenry", "nh"],
    "Ω": ["ohm", "ohms", "R"],
    "kΩ": ["kohm", "k-ohm", "kR"],
    "MΩ": ["Mohm", "megohm", "MR"],
    "Hz": ["hertz", "hz"],
    "kHz": ["kilohertz", "khz"],
    "MHz": ["megahertz", "mhz", "Mhz"],
    "GHz": ["gigahertz", "ghz"],
    "°C": ["C", "degC", "deg C", "celsius"],
    "°F": ["F", "degF", "deg F", "fahrenheit"],
    "ns": ["nanosecond", "nanosec"],
    "µs": ["us", "μs", "microsecond", "microsec"],
    "ms": ["millisecond", "millisec"],
    "s": ["sec", "second", "seconds"],
}


def lookup() -> dict[str, str]:
    return {name.lower(): unit for unit, names in SPELLINGS.items() for name in [unit, *names]}


def normal_unit(c: Column) -> Column:
    """The canonical unit of a spelling, whatever its case; an unknown unit stays, without white space around it."""
    known = F.create_map(*[F.lit(x) for pair in lookup().items() for x in pair])
    bare = strip(F.coalesce(c, F.lit("")))
    return F.coalesce(F.try_element_at(known, F.lower(bare)), bare)


def units_match(a: Column, b: Column) -> Column:
    return normal_unit(a) == normal_unit(b)
