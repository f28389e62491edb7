"""Every registered query of this subpackage and its SQL, where SQL can express it."""

from __future__ import annotations

from functools import wraps

from siniestro.llm import (
    class_lm, decontamination, language_id, license_scan, line_dedup, metric_tree, mixing, pieces, prefix_trie, sharding,
    simhash, substring_dedup, walsh_clusters)
from siniestro.session import ready_for_python

MODULES = (metric_tree, line_dedup, substring_dedup, license_scan, pieces, simhash, sharding, language_id,
           decontamination, class_lm, prefix_trie, mixing, walsh_clusters)


def _with_code(query):
    """The query, in a session fit for Python tasks."""
    @wraps(query)
    def run(spark, sf_dir):
        ready_for_python(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _with_code(query) for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
