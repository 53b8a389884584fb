"""subledger: subscription-business KPIs as Spark DataFrame plans.

Layers (each a set of DataFrame -> DataFrame functions):

* ``sources``   raw files -> bronze string tables (NDJSON with line numbers,
                JSON arrays, CSV with a corrupt-row channel) and adapters that
                derive pipeline inputs from the shared test tables.
* ``functions`` column expressions (text cleaning, numeric coercion,
                zone-safe timestamp parsing, week arithmetic, guarded ratios).
* ``operators`` reusable building blocks (reject split, keep-latest dedup,
                skew-safe ordered lag, interval sums, calendar fill, ...).
* ``plans``     the products: silver cleaning, gold facts, dimensions, views,
                catalog load and the end-to-end pipeline run.
* ``llm``       operators on training-data corpora; a subpackage that the rest
                neither needs nor imports.
"""

__version__ = "0.1.0"
