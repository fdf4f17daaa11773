"""All registered queries over the contest tables, with their SQL."""

from contestry.plans import curations, experiments, features, files, forecasts, landings, learning, maintenance, models, payloads, reports, streams, trainings, upcoming

QUERIES: dict = {}
ORACLE: dict = {}
for part in (features, reports, payloads, models, forecasts, curations, learning, landings, trainings, experiments, maintenance, streams, upcoming, files):
    QUERIES.update(part.QUERIES)
    ORACLE.update(part.ORACLE)

FLAGSHIP = "w1_trailing_form"
