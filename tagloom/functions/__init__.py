"""Column expressions. Everything here is a native Spark expression (no
Python UDF), so Catalyst can push, prune and fold around it."""

from tagloom.functions.dates import parse_dump_date
from tagloom.functions.tags import (decode_indexes, keep_tags, label_indexes, split_tags,
                                    target_column)
from tagloom.functions.text import (remove_stop_words, stop_words, tokenize)

__all__ = [
    "parse_dump_date", "split_tags", "keep_tags", "target_column", "label_indexes",
    "decode_indexes", "tokenize", "remove_stop_words", "stop_words",
]
