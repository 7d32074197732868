"""Explicit schemas, so no stage ever infers types."""

RECORDING_PAYLOAD = """
    id string, title string, length bigint, disambiguation string,
    releases array<struct<date: string, `release-group`: struct<`primary-type`: string>>>,
    `artist-credit` array<struct<artist: struct<
        name: string, type: string, country: string, `life-span`: struct<begin: string>>>>
"""

_POPULARITY_ITEM = (
    "recording_mbid: string, total_listen_count: bigint, total_user_count: bigint"
)
# A response wraps its items in `payload` or `data`, or is the bare list itself, in which case the
# reader yields the items as rows.
POPULARITY_RESPONSE = f"""
    payload array<struct<{_POPULARITY_ITEM}>>, data array<struct<{_POPULARITY_ITEM}>>,
    recording_mbid string, total_listen_count bigint, total_user_count bigint
"""

AUDIO_PAYLOAD = """
    rhythm struct<bpm: double, danceability: double>,
    tonal struct<key_key: string, key_scale: string>,
    lowlevel struct<average_loudness: double, dynamic_complexity: double>
"""

RAW_RECORDS = """
    mbid string, title string, duration_ms bigint, genre string, disambiguation string,
    release_type string, release_year string, artist_name string, artist_type string,
    artist_country string, artist_begin string, ingest_seq bigint
"""

POPULARITY = "mbid string, total_listen_count bigint, total_user_count bigint"

AUDIO = """
    mbid string, tempo double, danceability double, key string, key_scale string,
    loudness double, dynamic_complexity double
"""

PROCESSED = """
    mbid string, title string, artist_name string, genre string, genre_tags_text string,
    genre_match_count int, release_type string, release_year int, release_decade int,
    artist_type string, artist_country string, artist_begin_year int, artist_career_age int,
    track_age int, duration_ms double, duration_sec double, tempo double, danceability double,
    loudness double, dynamic_complexity double, key string, key_scale string,
    has_audio_features tinyint, audio_feature_missing_count int, career_x_duration_min double,
    tempo_x_dance double, total_listen_count bigint, total_user_count bigint,
    repeat_listens bigint, log_repeat_listens double, genre_enc int, release_type_enc int,
    artist_type_enc int, artist_country_enc int, key_enc int, key_scale_enc int,
    disambiguation string, artist_begin string, is_high_replay tinyint
"""
