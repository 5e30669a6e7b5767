"""Registered queries and the SQL they are compared with.

Each module has ``QUERIES`` (Spark) and ``ORACLES`` (DuckDB SQL). All of them
read whole tables; inputs that the driver tables lack are derived from them
row by row, by the same rules in both dialects.
"""

from checks import answers, detection, outcomes, rewriting, transcripts  # noqa: E402

MODULES = (rewriting, detection, transcripts, answers, outcomes)
