"""Object graphs of documents in JSON: which keys, key paths, values and filter chains they hold."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessellar.functions.strings import escape_controls

# Keys whose numbers are kept as they are.
NUMBER_KEYS = frozenset(
    "/BitsPerComponent /BitsPerCoordinate /BitsPerSample /ca /CA /Colors /ColorTransform /Count /Descent /EarlyChange /F /Ff /FL /FontWeight /FormType /FunctionType /Gamma /HalftoneType /I /LC"
    " /Length /LJ /LW /M /ML /N /O /OPM /Order /P /PaintType /PatternType /Penalty /Position /Predictor /Q /R /Rotate /RT /S /ShadingType /SM /SMaskInData /St /TilingType /TP /UserUnit /V /Version"
    " /VerticesPerRow /Volume /W /WMode".split()
)
# Keys whose strings are texts, and names that a specification numbers freely.
STRING_KEYS = frozenset(["/CharSet", "/Title", "/DA"])
NUMBERED = r"\A/(?:(?:R|CS|Cs|cs|GS|Gs|gs|P|p|SH|Sh|sh|F|FM|Fm|fm|I|IM|Im|XO|Xo|TT|MC)\d+|TT\d+_\d+)\Z"
MOST_DEPTH, MOST_CHARS, MOST_ENTRIES = 30, 100, 1000

_REF, _DATE = re.compile(r"\d+ \d+ R"), re.compile(r"D:\d{14,}")
FIELDS = ("keys", "parent_and_keys", "type_keys", "keys_and_values", "filters")
_SCHEMA = T.StructType([T.StructField("status", T.StringType()), *(T.StructField(f, T.ArrayType(T.StringType())) for f in FIELDS), T.StructField("max_filter_count", T.IntegerType())])


def objects_of(root: dict) -> dict[str, object] | None:
    """Reference -> value in either layout of the tool: ``qpdf`` list with obj: keys, or an ``objects`` map."""
    if isinstance(root.get("objects"), dict):
        return {k: v for k, v in root["objects"].items() if _REF.fullmatch(k)}
    for part in root.get("qpdf") or ():
        if isinstance(part, dict) and any(k.startswith("obj:") for k in part):
            out: dict[str, object] = {}
            for k, v in part.items():
                if k.startswith("obj:") and _REF.fullmatch(k[4:]) and isinstance(v, dict):
                    out[k[4:]] = v["value"] if "value" in v else v.get("stream", {}).get("dict")
            return out
    return None


class _Walk:
    def __init__(self, objects: dict[str, object], marked: bool) -> None:
        self.objects, self.marked = objects, marked
        self.found: dict[str, set[str]] = {f: set() for f in FIELDS}
        self.most = 0

    def run(self) -> None:
        # an explicit stack: documents may nest deeper than Python does
        stack = [(k, v) for k, v in self.objects.items() if isinstance(v, (dict, list))]
        while stack:
            parent, node = stack.pop()
            stack += self._dict(parent, node) if isinstance(node, dict) else self._list(parent, node)

    def _list(self, parent: str, node: list) -> Iterator[tuple[str, object]]:
        if not _REF.fullmatch(parent):
            self.found["parent_and_keys"].add(f"{parent}->ARRAY")
        return ((parent, x) for x in node if isinstance(x, (dict, list)))

    def _dict(self, parent: str, node: dict) -> Iterator[tuple[str, object]]:
        self.found["keys"].update(node)
        if not _REF.fullmatch(parent):
            self.found["parent_and_keys"].update(f"{parent}->{k}" for k in node)
        kind = node.get("/Type")
        if isinstance(kind, str):
            self.found["type_keys"].update(f"{kind}->{k}" for k in node if k != "/Type")
        for k, v in node.items():
            if not isinstance(v, (dict, list)) and (plain := self._value(k, v)) is not None:
                self.found["keys_and_values"].add(f"{k}->{plain}")
            if k == "/Filter":
                self._filters(v)
        return ((k, v) for k, v in node.items() if isinstance(v, (dict, list)))

    def _value(self, key: str, v: object) -> str | None:
        if v is None:
            return None
        if isinstance(v, bool):
            return str(v).upper()
        if isinstance(v, (int, float)):
            return str(v) if key in NUMBER_KEYS else "NUMBER"
        s = str(v)
        if not s.strip():
            return None
        if self.marked and s[:2] in ("u:", "b:"):
            s = s[2:]
        return "REF" if _REF.fullmatch(s) else "DATE" if _DATE.match(s) else "STRING" if key in STRING_KEYS else s

    def _resolve(self, v: object) -> object:
        """What a reference leads to; None for one that dangles or goes round in circles."""
        for _ in range(MOST_DEPTH + 1):
            if not (isinstance(v, str) and _REF.fullmatch(v)):
                return v
            v = self.objects.get(v)
        return None

    def _filters(self, v: object) -> None:
        real = self._resolve(v)
        if isinstance(real, list):
            chain = [x for x in map(self._resolve, real) if isinstance(x, str)]
            self.most = max(self.most, len(chain))
            self.found["filters"].add("->".join(chain))
        elif isinstance(v, str):
            self.most = max(self.most, 1)
            self.found["filters"].add(v)


def _walked(text: str | None) -> tuple:
    none = (None,) * len(FIELDS) + (None,)
    if text is None:
        return ("missing", *none)
    try:
        root = json.loads(text)
        objects = objects_of(root) if isinstance(root, dict) else None
    except (ValueError, RecursionError, AttributeError):
        objects = None
    if objects is None:
        return ("bad_extract", *none)
    w = _Walk(objects, "qpdf" in root)
    w.run()
    return ("ok", *(sorted(w.found[f]) for f in FIELDS), w.most)


def object_graph(text: Column) -> Column:
    """Struct<status, keys, parent_and_keys, type_keys, keys_and_values, filters, max_filter_count>, the sets sorted.

    Null text is 'missing', text that isn't such a graph 'bad_extract'. A reference that dangles or is circular ends the chain it is
    in. A single filter is named as it stands; only entries that are objects or lists are walked inside lists.
    """

    @F.pandas_udf(_SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_walked(t) for t in texts], columns=[f.name for f in _SCHEMA.fields])

    return run(text)


def graph_features(rows: DataFrame, graph: str, common: Sequence[str] = ()) -> DataFrame:
    """``rows`` with q_status, q_keys, q_keys_oos, q_parent_and_keys, q_type_keys, q_keys_and_values, q_filters and q_max_filter_count.

    Entries are cut to 100 characters and ``...``, control characters spelled out; the first 1000 in sorted order are kept. Keys out
    of specification are those neither in ``common`` nor numbered names.
    """

    def tidy(c: Column) -> Column:
        cut = F.transform(c, lambda s: F.when(F.length(escape_controls(s)) > MOST_CHARS, F.concat(F.substring(escape_controls(s), 1, MOST_CHARS), F.lit("..."))).otherwise(escape_controls(s)))
        return F.slice(F.array_sort(F.array_distinct(cut)), 1, MOST_ENTRIES)

    g = F.col(graph)
    keys = tidy(g["keys"])
    known = F.array(*(F.lit(k) for k in common)) if common else F.array().cast("array<string>")
    oos = F.filter(F.array_except(keys, known), lambda k: ~k.rlike(NUMBERED))
    return rows.withColumns({"q_status": F.when(g["status"] != "ok", g["status"]), "q_keys": keys, "q_keys_oos": oos, **{f"q_{f}": tidy(g[f]) for f in FIELDS[1:]}, "q_max_filter_count": g["max_filter_count"]})


def json_keys(text: Column) -> Column:
    """Keys of a JSON object, sorted; null where it is none."""
    return F.array_sort(F.json_object_keys(text))
