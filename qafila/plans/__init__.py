"""Query plans over the tables, with their SQL."""

from qafila.plans import corpus, details, selection, streams, tasks, telemetry

QUERY_SETS = [corpus, selection, telemetry, tasks, streams, details]
