"""Types of documents and their flattened tables."""

from __future__ import annotations

SPAN = "struct<index: int, start: int, end: int>"
BIB = "array<struct<id: bigint, title: string, year: int, authors: array<string>>>"
PAPER = "id bigint, s2orc_id bigint, mag_id bigint, doi string, title string, year int, authors array<string>"
#: The tree stays JSON text at rest; `tree.flatten` turns it into NODES and SPANS.
DOCUMENT = (
    "id bigint, s2orc_id bigint, mag_id bigint, doi string, title string, authors array<string>, year int, fields_of_study array<string>, citations array<bigint>, "
    f"hierarchy string, bibliography {BIB}, non_plaintext_content array<struct<kind: string, description: string>>, extra string"
)
RELATED_WORK = DOCUMENT + ", related_work string, related_work_orig_path array<int>"
NODES = "doc_id bigint, path array<int>, depth int, height int, headline string, text string"
SPANS = "doc_id bigint, path array<int>, kind string, pos int, index int, start int, end int"
EDGES = "citing bigint, cited bigint"
