"""Fixed values of the data model: column-name conventions of the plant's files."""

from __future__ import annotations

#: Kinds of raw sources, which are also the names of their folders.
KINDS = ("traceability", "trend", "defect", "repair")
#: A file-name stem's date suffix.
DATE_SUFFIX = r"_(\d{4}|\d{6}|\d{8})$"
#: Characters that stay in a normalised name.
SAFE_CHARACTERS = "0-9A-Za-z_぀-ゟ゠-ヿ一-鿿"
#: Anchor columns: this name, else the first that contains a keyword.
TIME_COLUMN = "DATETIME"
TIME_KEYWORDS = ("通過日時", "DATETIME")
UNIT_COLUMN = "VIN"
UNKNOWN_DATE = "unknown"
DUMMY_UNIT = r"(?i)(DUMMY|EMPTY)"
#: Suffixes of columns that keep double precision.
KEEP_DOUBLE = ("積算値", "総合計")
#: Suffixes of columns that are measured once for each robot and so are averaged.
STAT_SUFFIXES = ("測定値", "設定値", "RT値", "使用量", "充填量", "排出量", "サイクルタイム")
#: Suffixes of trend columns that are used.
TREND_SUFFIXES = ("測定値", "計算値")
#: Categories that an exact lookup gives to rows that it has no value for.
OUT_OF_SCOPE, UNMATCHED, EXCLUDED = "対象外工程", "未分類", "グラフ対象外"
EXCLUDED_VALUES = ("-",)
#: Column pruning: what is kept whatever its values.
PROTECTED_COLUMNS = ("vin", "vin_base", "vin_pass_no", "vin_format", "has_repair_record")
PROTECTED_PREFIXES = ("present__", "defect_", "repair_")
PROTECTED_SUBSTRINGS = ("フラグ",)
#: Outcome columns, which may not explain outcomes.
LEAKAGE_PREFIXES = ("defect", "repair", "has_repair")
ID_COLUMNS = ("vin", "vin_base")
