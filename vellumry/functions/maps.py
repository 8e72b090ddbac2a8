"""Label records as maps: info type to polygons, document key to record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Info types in order, their colours, and the names they had before.
INFO_TYPES = ["src_content", "src_metadata", "src_salutation", "archv_commentary", "doc_struct", "struct_commentary", "possessor", "other"]
COLORS = {"src_content": "#ff4d4d", "src_metadata": "#f5a623", "src_salutation": "#f5a623", "archv_commentary": "#ffd166", "doc_struct": "#4f70ff", "struct_commentary": "#ff4fa3", "possessor": "#3ddc97", "other": "#9e9e9e"}
DEFAULT_COLOR = "#ffffff"
LEGACY = {"document_content": "src_content", "header_data": "src_metadata", "commentary": "archv_commentary", "possessor_notes": "possessor"}
POLYGONS = "array<array<struct<x:double,y:double>>>"
RECORD = f"map<string,{POLYGONS}>"
MOST_DOCUMENTS = 20


def _none() -> Column:
    return F.array().cast(POLYGONS)


def empty_record() -> Column:
    return F.map_from_arrays(F.array(*[F.lit(t) for t in INFO_TYPES]), F.array_repeat(_none(), len(INFO_TYPES)))


def with_new_names(record: Column) -> Column:
    """Polygons under an old name are shown under the new one too, if there are none yet; old keys stay."""
    def shown(r: Column, old: str, new: str) -> Column:
        take = (F.size(F.coalesce(r[old], _none())) > 0) & (F.size(F.coalesce(r[new], _none())) == 0)
        rest = F.map_filter(r, lambda k, _: k != new)
        return F.when(take, F.map_concat(rest, F.create_map(F.lit(new), r[old]))).otherwise(r)

    out = record
    for old, new in LEGACY.items():
        out = shown(out, old, new)
    return out


def with_all_types(record: Column) -> Column:
    return F.map_zip_with(empty_record(), record, lambda _, e, v: F.coalesce(v, e))


def number_of_documents(text: Column, old: Column) -> Column:
    """1 to 20; what isn't a number gives the old value."""
    return F.greatest(F.lit(1), F.least(F.lit(MOST_DOCUMENTS), F.coalesce(F.trim(text).try_cast("int"), old)))


def without_surplus(documents: Column, n: Column) -> Column:
    """Drops ``doc_k`` beyond the number; other keys stay."""
    k = lambda key: F.when(key.startswith("doc_"), F.substr(key, F.lit(5)).try_cast("int"))
    return F.map_filter(documents, lambda key, _: F.coalesce(k(key) <= n, F.lit(True)))


def with_all_documents(documents: Column, n: Column) -> Column:
    keys = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("doc_"), i.cast("string")))
    wanted = F.map_from_arrays(keys, F.array_repeat(empty_record(), n))
    return F.map_zip_with(wanted, documents, lambda _, e, v: F.coalesce(v, e))


def in_type_order(record: Column) -> Column:
    return F.array(*[F.struct(F.lit(t).alias("info_type"), F.coalesce(record[t], _none()).alias("polygons")) for t in INFO_TYPES])


def color(info_type: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in COLORS.items() for x in kv])[info_type], F.lit(DEFAULT_COLOR))
