"""Schemas of the native inputs; nothing is inferred on reading."""

from __future__ import annotations

from pyspark.sql import types as T

SPAN = "struct<offset:bigint,length:bigint>"
WORD = f"struct<content:string,polygon:array<double>,confidence:double,span:{SPAN}>"
LINE = f"struct<content:string,polygon:array<double>,spans:array<{SPAN}>>"
OCR_PAGES = f"pages array<struct<pageNumber:bigint,words:array<{WORD}>,lines:array<{LINE}>>>"
POINTS = "array<struct<x:double,y:double>>"
PAGE_SIZE = "page_number bigint, width_points double, height_points double, width_inches double, height_inches double, width_pixels bigint, height_pixels bigint, render_dpi bigint, source_pdf string"
POLYGON = f"page_number bigint, page_width bigint, page_height bigint, render_dpi bigint, polygon {POINTS}, source_pdf string"
LABEL_PAGE = f"page_number bigint, source_file string, page_width bigint, page_height bigint, render_dpi bigint, num_documents bigint, documents map<string,map<string,array<{POINTS}>>>"
ERRORS = "errors array<struct<error_id:bigint,error_type:string,source_document:string,page_number:bigint,line_number:bigint,word_number:bigint,character_number:bigint,context:struct<line_text:string>,error:string,bounding_boxes:struct<context:array<double>,error:array<double>>,images:struct<context:string,error:string>>>"


def parsed(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)
