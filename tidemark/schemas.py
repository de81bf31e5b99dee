"""Explicit schemas: nothing is inferred, so an empty or odd day reads like any other."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, FLAG, COUNT, WHOLE, REAL, INSTANT = (
    T.StringType(), T.BooleanType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType(),
)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def listed(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


# A live change event, as the public stream sends it.
CHANGE_EVENT = record(
    server_name=TEXT, bot=FLAG, namespace=WHOLE, type=TEXT, timestamp=REAL, title=TEXT, user=TEXT, minor=FLAG,
    length=record(old=COUNT, new=COUNT), revision=record(new=COUNT), comment=TEXT,
)

# An edit message. ``timestamp`` is a double because a BIGINT would null out 1.5.
EDIT_MESSAGE = record(
    timestamp=REAL, project=TEXT, title=TEXT, user=TEXT, type=TEXT, minor=FLAG, length_old=COUNT,
    length_new=COUNT, comment=TEXT, rev_id=COUNT,
)

EDITS = record(
    timestamp_utc=INSTANT, project=TEXT, rev_id=COUNT, title=TEXT, user=TEXT, type=TEXT, minor=FLAG,
    edit_size=COUNT, length_old=COUNT, length_new=COUNT, comment=TEXT,
)

# Per article, in the folder of its day.
EDIT_COUNTS = record(project=TEXT, title=TEXT, edit_count=COUNT, unique_editors=COUNT)
# Per article and editor: edits dated on another day than their folder's, and who else edited the same that day.
MISFILED_EDITORS = record(dated=TEXT, project=TEXT, title=TEXT, user=TEXT, edit_count=COUNT)
SHARED_EDITORS = record(project=TEXT, title=TEXT, user=TEXT, edit_count=COUNT)
ENTITY_REQUESTS = record(project=TEXT, titles=listed(TEXT))

HOURLY_TSV = record(hour_utc=TEXT, project=TEXT, title=TEXT, views=COUNT)
HOURLY_VIEWS = record(hour_utc=INSTANT, project=TEXT, title=TEXT, views=COUNT)

DAILY_TOP_JSON = record(items=listed(record(articles=listed(record(article=TEXT, views=COUNT, rank=COUNT)))))
DAILY_TOP = record(date_utc=INSTANT, project=TEXT, rank=COUNT, article=TEXT, views=COUNT)

RENAME = T.StructType([T.StructField("from", TEXT), T.StructField("to", TEXT)])
ENTITY_BODY = T.StructType(
    [
        T.StructField("error", record(code=TEXT, info=TEXT)),
        T.StructField("continue", TEXT),
        T.StructField(
            "query",
            record(
                normalized=listed(RENAME),
                redirects=listed(RENAME),
                pages=listed(record(title=TEXT, missing=FLAG, pageprops=record(wikibase_item=TEXT))),
            ),
        ),
    ]
)
ENTITY_RESPONSE = record(project=TEXT, status=WHOLE, titles=listed(TEXT), body=ENTITY_BODY)
ENTITY_IDS = record(project=TEXT, title=TEXT, wikidata_id=TEXT)

TRENDING = record(
    title=TEXT, edit_project=TEXT, pageview_project=TEXT, edit_count=COUNT, total_edit_size=COUNT,
    unique_editors=COUNT, first_edit=INSTANT, last_edit=INSTANT, edit_velocity=REAL, wikidata_id=TEXT,
    pageviews=COUNT, pageview_rank=COUNT, trending_score=REAL, history_days=WHOLE, baseline_editors=REAL,
    is_emerging=FLAG, z_editors=REAL, z_edits=REAL, anomaly_score=REAL, entity_key=TEXT, language_count=COUNT,
    languages_editing=TEXT, first_language=TEXT, language_lag_minutes=REAL,
)
EDIT_TO_VIEW = record(
    title=TEXT, edit_project=TEXT, pageview_project=TEXT, edit_count=COUNT, total_edit_size=COUNT,
    unique_editors=COUNT, first_edit=INSTANT, last_edit=INSTANT, edit_velocity=REAL, wikidata_id=TEXT,
    pageviews=COUNT, pageview_rank=COUNT, edit_to_view_ratio=REAL,
)
CROSS_LANGUAGE = record(
    wikidata_id=TEXT, language_count=COUNT, languages_editing=TEXT, first_language=TEXT, first_edit=INSTANT,
    spread_minutes=REAL, titles=TEXT, total_edits=COUNT, sum_editors=COUNT, total_pageviews=COUNT,
    emerging_languages=WHOLE, is_emerging=FLAG,
)
CROSS_LANGUAGE_TITLES = record(
    wikidata_id=TEXT, first_edit=INSTANT, edit_project=TEXT, title=TEXT, language_title=TEXT, position=COUNT,
)
LEADLAG_HOURLY = record(
    project=TEXT, title=TEXT, event_edits=COUNT, total_views=COUNT, best_lag_hours=WHOLE, best_corr=REAL,
    p_value=REAL, peak_lag_hours=WHOLE, edit_peak_utc=INSTANT, view_peak_utc=INSTANT, view_surge_ratio=REAL,
    pattern=TEXT,
)
