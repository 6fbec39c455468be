"""Catalog specification, read from the same JSON configuration keys the
reference service uses (``key``, ``association``, ``in columns`` ...).

Only specs live on the driver; they are small by construction.
"""

from __future__ import annotations

import copy
import graphlib
import json
from dataclasses import dataclass, field

# Fixed values that must equal the reference's defaults.
# Null tokens, in the order of the default configuration (19 entries, 17 distinct).
DEFAULT_NULL_TOKENS = [
    "<NA>", "NA", "N/A", "na", "Na", "n/a", "None", "null", "", "pd.NA", "pd.NaT",
    "pd.NA", "pd.NaT", "nan", "NaN", "NAN", "missing value", "Missing Value", "MISSING VALUE",
]
# Characters outside this class are deleted from column names ("*" = off).
DEFAULT_CHARACTER_SCOPE = (
    "[^A-Za-z0-9çÇãÃõÕáÁéÉíÍóÓúÚàÀèÈìÌòÒùÙâÂêÊîÎôÔûÛäÄëËïÏöÖüÜÿŒœÆæ%|?!.,><°\"-_ ]+"
)
DEFAULT_TABLE = "_"          # root leftovers / single-table files
DEFAULT_SHEET_NAME = "<name>"  # display name meaning "the configuration's name"
MANY_TABLES = "*"            # "many tables" marker in the metadata regex map
UNLIMITED_SCOPE = "*"
DEFAULT_CSV_SEPARATOR = ";"
DEFAULT_CLEAN_PERIOD_HOURS = 1
DEFAULT_CHECK_PERIOD_SECONDS = 10
DEFAULT_MAX_FILE_VARIATIONS = 100
# Values of the published flag column.
FLAG_TRUE = "True"
FLAG_FALSE = "False"
# Separator of merged duplicate values.
MERGE_SEPARATOR = ", "
# Text written for a null key part.
NULL_KEY_PART = "<NA>"

_TOP_KEYS = {
    "name", "test mode", "check period in seconds", "clean period in hours",
    "delay first clean", "last clean", "maximum errors before exit", "maximum file variations",
    "character scope", "languages", "null string values", "default worksheet key",
    "default multiple object key", "default unlimited characters scope", "default worksheet name",
    "overwrite data in store", "overwrite data in get", "overwrite data in trash",
    "discard invalid data files", "log", "folders", "files", "metadata",
}
_FILES_KEYS = {
    "metadata file regex", "data file regex", "catalog names", "table names", "input to ignore",
    "metadata file formatting", "csv separator",
}
_METADATA_KEYS = {
    "required tables", "force table identification", "key", "association", "in columns", "sort by",
    "data filenames", "data published flag", "add filename", "add file timestamp",
    "filename data format", "filename data processing rules",
}


class SpecError(ValueError):
    pass


@dataclass(frozen=True)
class PrimaryKey:
    name: str
    int_type: bool = False
    relative: bool = False
    delete_orphan: bool = False


@dataclass(frozen=True)
class ForeignKey:
    parent: str
    name: str
    delete_orphan: bool = False


@dataclass
class TableSpec:
    name: str
    key: list[str] = field(default_factory=list)
    in_columns: list[str] = field(default_factory=list)
    pk: PrimaryKey | None = None
    fks: list[ForeignKey] = field(default_factory=list)
    sort_by: list[tuple[str, bool]] = field(default_factory=list)
    data_filenames: list[str] = field(default_factory=list)
    published_flags: list[str] = field(default_factory=list)
    add_filename: str | None = None
    add_file_timestamp: str | None = None
    filename_format: str | None = None
    filename_rules: dict = field(default_factory=dict)

    @property
    def key_columns(self) -> list[str]:
        """Key parts in sorted order (deterministic, unlike a set)."""
        return sorted(dict.fromkeys(self.key))

    @property
    def added_columns(self) -> set[str]:
        """Columns the engine creates itself (file name, mtime, name groups, flags)."""
        from tessera.functions.regex import group_names

        out = set(self.published_flags)
        if self.add_filename:
            out.add(self.add_filename)
        if self.add_file_timestamp:
            out.add(self.add_file_timestamp)
        if self.filename_format:
            out.update(group_names(self.filename_format))
        return out

    @property
    def required_columns(self) -> set[str]:
        """``in columns`` ∪ key, minus what the engine adds itself."""
        return (set(self.in_columns) | set(self.key)) - self.added_columns


@dataclass
class CatalogSpec:
    name: str = "unnamed"
    tables: dict[str, TableSpec] = field(default_factory=dict)
    null_tokens: list[str] = field(default_factory=lambda: list(DEFAULT_NULL_TOKENS))
    character_scope: str = DEFAULT_CHARACTER_SCOPE
    csv_separator: str = DEFAULT_CSV_SEPARATOR
    required_tables: list[str] = field(default_factory=lambda: [DEFAULT_TABLE])
    force_identification: bool = False
    table_names: dict[str, str] = field(default_factory=dict)
    metadata_regex: dict[str, str] = field(default_factory=dict)
    data_regex: dict[str, str] = field(default_factory=dict)
    ignore: list[str] = field(default_factory=list)
    get_folders: dict[str, list[str]] = field(default_factory=dict)
    store_folders: list[str] = field(default_factory=list)
    post_folders: list[str] = field(default_factory=list)
    trash_folder: str | None = None
    catalog_names: list[str] = field(default_factory=list)
    clean_period_hours: float = DEFAULT_CLEAN_PERIOD_HOURS
    check_period_seconds: float = DEFAULT_CHECK_PERIOD_SECONDS
    max_file_variations: int = DEFAULT_MAX_FILE_VARIATIONS
    delay_first_clean: bool = True
    overwrite_get: bool = True
    overwrite_store: bool = False
    overwrite_trash: bool = False
    discard_invalid: bool = False
    test_mode: bool = False

    # ------------------------------------------------------------------ graph
    def parents_of(self, table: str) -> list[str]:
        return [fk.parent for fk in self.tables[table].fks if fk.parent in self.tables]

    def children_of(self, table: str) -> list[tuple[str, ForeignKey]]:
        """Back references: (child table, its FK) for every FK naming ``table``."""
        return [(t.name, fk) for t in self.tables.values() for fk in t.fks if fk.parent == table]

    def topological_order(self) -> list[str]:
        """Parents before children; a cycle is a configuration error."""
        ts = graphlib.TopologicalSorter({t: set(self.parents_of(t)) for t in self.tables})
        try:
            return list(ts.static_order())
        except graphlib.CycleError as exc:  # pragma: no cover - message only
            raise SpecError(f"foreign keys form a cycle: {exc.args[1]}") from exc

    def table(self, name: str) -> TableSpec:
        return self.tables[name]

    def display_name(self, table: str) -> str | None:
        """Worksheet name of a table (``<name>`` stands for the config's name)."""
        shown = self.table_names.get(table)
        return self.name if shown == DEFAULT_SHEET_NAME else shown

    # ------------------------------------------------------------------ loading
    @classmethod
    def from_config(cls, config: dict | str) -> "CatalogSpec":
        if isinstance(config, str):
            with open(config, encoding="utf-8") as fh:
                config = json.load(fh)
        config = copy.deepcopy(config)
        unknown = {k for k in set(config) - _TOP_KEYS if not k.endswith(" version")}
        if unknown:
            raise SpecError(f"unknown configuration keys: {sorted(unknown)}")
        files = config.get("files", {})
        meta = config.get("metadata", {})
        for section, allowed, label in ((files, _FILES_KEYS, "files"), (meta, _METADATA_KEYS, "metadata")):
            bad = set(section) - allowed
            if bad:
                raise SpecError(f"unknown keys under {label!r}: {sorted(bad)}")
        folders = config.get("folders", {})
        # The separator is accepted at both documented places.
        fmt = files.get("metadata file formatting", {})
        sep = fmt.get("csv separator", files.get("csv separator", DEFAULT_CSV_SEPARATOR))

        keys = meta.get("key", {DEFAULT_TABLE: []})
        in_cols = meta.get("in columns", {DEFAULT_TABLE: []})
        assoc = meta.get("association", {})
        names = set(keys) | set(in_cols) | set(assoc)
        tables: dict[str, TableSpec] = {}
        for t in sorted(names):
            a = assoc.get(t, {})
            pk = None
            if "PK" in a:
                p = a["PK"]
                pk = PrimaryKey(p["name"], bool(p.get("int type", False)),
                                bool(p.get("relative value", a.get("relative value", False))),
                                bool(p.get("delete orphan", False)))
            fks = []
            for parent, v in a.get("FK", {}).items():
                if isinstance(v, str):
                    fks.append(ForeignKey(parent, v, False))
                else:
                    fks.append(ForeignKey(parent, v["name"], bool(v.get("delete orphan", False))))
            tables[t] = TableSpec(
                name=t, key=list(keys.get(t, [])), in_columns=list(in_cols.get(t, [])), pk=pk, fks=fks,
                sort_by=_sort_rule(meta.get("sort by", {}).get(t)),
                data_filenames=list(meta.get("data filenames", {}).get(t, [])),
                published_flags=_as_list(meta.get("data published flag", {}).get(t, [])),
                add_filename=meta.get("add filename", {}).get(t),
                add_file_timestamp=meta.get("add file timestamp", {}).get(t),
                filename_format=meta.get("filename data format", {}).get(t),
                filename_rules=meta.get("filename data processing rules", {}) if t in meta.get(
                    "filename data format", {}) else {},
            )
        spec = cls(
            name=config.get("name", "unnamed"), tables=tables,
            null_tokens=list(config.get("null string values", DEFAULT_NULL_TOKENS)),
            character_scope=config.get("character scope", DEFAULT_CHARACTER_SCOPE),
            csv_separator=sep,
            required_tables=list(meta.get("required tables", [DEFAULT_TABLE])),
            force_identification=bool(meta.get("force table identification", False)),
            table_names=dict(files.get("table names", {DEFAULT_TABLE: DEFAULT_SHEET_NAME})),
            metadata_regex=dict(files.get("metadata file regex", {})),
            data_regex=dict(files.get("data file regex", {})),
            ignore=list(files.get("input to ignore", [])),
            get_folders={k: _as_list(v) for k, v in folders.get("get", {}).items()},
            store_folders=_as_list(folders.get("store", [])),
            post_folders=_as_list(folders.get("post", [])),
            trash_folder=folders.get("trash") or None,
            catalog_names=list(files.get("catalog names", [])),
            clean_period_hours=float(config.get("clean period in hours", DEFAULT_CLEAN_PERIOD_HOURS)),
            check_period_seconds=float(config.get("check period in seconds", DEFAULT_CHECK_PERIOD_SECONDS)),
            max_file_variations=int(config.get("maximum file variations", DEFAULT_MAX_FILE_VARIATIONS)),
            delay_first_clean=bool(config.get("delay first clean", True)),
            overwrite_get=bool(config.get("overwrite data in get", True)),
            overwrite_store=bool(config.get("overwrite data in store", False)),
            overwrite_trash=bool(config.get("overwrite data in trash", False)),
            discard_invalid=bool(config.get("discard invalid data files", False)),
            test_mode=bool(config.get("test mode", False)),
        )
        spec.topological_order()  # validates the FK graph
        for t in spec.tables.values():
            for fk in t.fks:
                if fk.parent not in spec.tables:
                    raise SpecError(f"{t.name}: FK parent {fk.parent!r} is not a table")
        return spec


def _as_list(v) -> list:
    if v is None or v == "":
        return []
    return list(v) if isinstance(v, (list, tuple)) else [v]


def _sort_rule(rule) -> list[tuple[str, bool]]:
    if not rule:
        return []
    by = _as_list(rule.get("by", []))
    asc = rule.get("ascending", True)
    flags = [bool(asc)] * len(by) if isinstance(asc, bool) else [bool(a) for a in asc]
    if len(flags) != len(by):
        raise SpecError("sort rule: 'ascending' must be one flag or one per column")
    return list(zip(by, flags))
