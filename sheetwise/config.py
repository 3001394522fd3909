"""Settings of the engine, from dictionaries and simple YAML files, and the registry of parts that can be plugged in."""

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields


@dataclass
class Settings:
    """What a run is told; the defaults are the specified ones."""

    primary_engine: str = "vision"
    secondary_engine: str = "rule"
    vision_model: str = "gpt-4o-mini"
    fallback_model: str = "gpt-4o"
    verification_enabled: bool = True
    numeric_tolerance: float = 0.01
    confidence_threshold: float = 0.60
    critical_params: list[str] = field(default_factory=list)
    output_format: str = "json"
    include_raw: bool = False
    include_conflicts: bool = True
    budget_per_datasheet: float = 0.50
    alert_threshold: float = 0.80

    @classmethod
    def from_dict(cls, values: dict) -> "Settings":
        """Takes the known keys, ignores others."""
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in values.items() if k in known})

    @classmethod
    def from_yaml(cls, path: str) -> "Settings":
        """A file of `key: value` lines and lists of `- value` lines; unknown keys are an error."""
        with open(path, encoding="utf-8") as f:
            return cls(**parse_yaml(f.read()))

    def to_yaml(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            for name, value in asdict(self).items():
                if isinstance(value, list) and value:
                    f.write(f"{name}:\n" + "".join(f"- {_shown(v)}\n" for v in value))
                else:
                    f.write(f"{name}: {_shown(value)}\n")


def _shown(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def _scalar(text: str):
    text = text.strip()
    if text[:1] in "\"'[" and text[-1:] in "\"']" and text:
        return json.loads(text) if text[0] != "'" else text[1:-1].replace("''", "'")
    bare = text.split(" #")[0].strip()
    if bare.lower() in ("true", "false"):
        return bare.lower() == "true"
    if bare.lower() in ("", "null", "~"):
        return None
    for kind in (int, float):
        try:
            return kind(bare)
        except ValueError:
            continue
    return bare


def parse_yaml(text: str) -> dict:
    """Flat YAML: one key a line, with a scalar or a list under it."""
    out: dict = {}
    key = None
    for number, line in enumerate(text.splitlines(), 1):
        bare = line.strip()
        if not bare or bare.startswith("#") or bare == "---":
            continue
        if bare.startswith("- ") or bare == "-":
            if key is None or (out[key] is not None and not isinstance(out[key], list)):
                raise ValueError(f"line {number}: a list entry without a key")
            out[key] = [*(out[key] or []), _scalar(bare[1:])]
        else:
            key, colon, value = bare.partition(":")
            if not colon or line[0] == " ":
                raise ValueError(f"line {number}: only flat keys are read")
            out[key.strip()] = _scalar(value)
            key = key.strip()
    return out


class Registry:
    """Named parts of one kind: functions that make or are comparators, arbiters, engines, formatters or clients."""

    def __init__(self, kind: str, parts: dict[str, Callable] | None = None):
        self.kind, self.parts = kind, parts if parts is not None else {}

    def register(self, name: str, part: Callable) -> None:
        self.parts[name] = part

    def create(self, name: str) -> Callable:
        if name not in self.parts:
            raise ValueError(f"no {self.kind} named {name!r}; there are {', '.join(self.list_types()) or 'none'}")
        return self.parts[name]

    def list_types(self) -> list[str]:
        return sorted(self.parts)
