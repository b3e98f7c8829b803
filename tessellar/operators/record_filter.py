"""Record filters from their JSON layout, compiled to columns.

A record is tested in this order: status set, ``defaultProbability`` (which skips all mime tests), exact mimes, exact detected
mimes, regular expressions on mimes, then on detected mimes, at last ``defaultInclude``. The first rule that matches is final,
also where its sampling leaves the record out. A rule's ``probability`` may be absent (everything), a number or a quoted number;
0 means nothing. ``case_sensitive`` counts at the root only. A null or unlisted status is rejected; an empty status set accepts
every status, null too. Regular expressions are searched for in the order of the file, and match letter case.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessellar.functions.strings import normalize_mime

DEFAULT = "default"


@dataclass(frozen=True)
class Rule:
    kind: str  # exact or regex
    field: str  # mimes or detected_mimes
    pattern: str
    probability: float

    @property
    def name(self) -> str:
        return f"{self.kind}.{self.field}:{self.pattern}"


@dataclass(frozen=True)
class RecordFilter:
    rules: tuple[Rule, ...] = ()
    status: tuple[int, ...] = ()
    default_include: bool = False
    default_probability: float = 1.0
    case_sensitive: bool = False

    @property
    def thinned(self) -> bool:
        return 0 <= self.default_probability < 1

    def rates(self) -> dict[str, float]:
        """Stratum -> part of its records that is to be taken."""
        if self.thinned:
            return {DEFAULT: self.default_probability}
        out: dict[str, float] = {}
        for r in self.rules:
            out.setdefault(r.name, r.probability)
        if self.default_include:
            out[DEFAULT] = 1.0
        return out

    def stratum(self, status: Column, mime: Column, detected: Column, tidy: bool = False) -> Column:
        """Name of the rule that decides on a record, null where the record is rejected whatever the sampling; ``tidy``: the mimes are normalised already."""
        ok = status.isin(*self.status) if self.status else F.lit(True)
        if self.thinned:
            return F.when(F.coalesce(ok, F.lit(False)), F.lit(DEFAULT))
        values = {"mimes": mime if tidy else normalize_mime(mime), "detected_mimes": detected if tidy else normalize_mime(detected)}
        out = F.lit(DEFAULT) if self.default_include else F.lit(None).cast("string")
        for r in reversed(self.rules):
            v = values[r.field]
            if r.kind == "regex":
                hit = v.rlike(r.pattern)
            else:
                hit = v == (r.pattern if self.case_sensitive else r.pattern.lower())
            out = F.when(hit, F.lit(r.name)).otherwise(out)
        return F.when(F.coalesce(ok, F.lit(False)), out)

    def accept(self, status: Column, mime: Column, detected: Column, key: Column) -> Column:
        """Whether a record passes; sampling by a hash of ``key``, so the same in every run and layout, and wider rates keep what narrower ones took."""
        s = self.stratum(status, mime, detected)
        rates = F.create_map(*(F.lit(x) for k, v in self.rates().items() for x in (k, v))) if self.rates() else None
        if rates is None:
            return F.lit(False)
        return F.coalesce(hash_unit(key) < F.try_element_at(rates, s), F.lit(False))


def hash_unit(key: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of SHA-256 of ``key``, which any other engine can repeat."""
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def load_filter(text: str | None) -> RecordFilter:
    """The filter of a JSON text; null or blank accepts everything."""
    if text is None or not text.strip():
        return RecordFilter(default_include=True)
    conf = json.loads(text)
    if not isinstance(conf, dict):
        raise ValueError("a record filter is a JSON object")
    rules = []
    for kind, field in (("exact", "mimes"), ("exact", "detected_mimes"), ("regex", "mimes"), ("regex", "detected_mimes")):
        for entry in conf.get(kind, {}).get(field, ()):
            p = entry.get("probability") if isinstance(entry, dict) else None
            pattern = entry["pattern"] if isinstance(entry, dict) else entry
            rules.append(Rule(kind, field, pattern, 1.0 if p is None or p == "" else min(1.0, max(0.0, float(p)))))
    status = conf.get("status", [])
    status = status if isinstance(status, list) else [status]
    return RecordFilter(tuple(rules), tuple(int(s) for s in status), bool(conf.get("defaultInclude", False)), float(conf.get("defaultProbability", 1.0)), bool(conf.get("case_sensitive", False)))


def has_probability(text: str | None) -> bool:
    """Whether a filter samples at all."""
    return bool(text) and '"probability"' in text or bool(text) and '"defaultProbability"' in text
