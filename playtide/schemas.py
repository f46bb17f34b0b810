"""Schemas of the payloads, the play event and the top-tracks document."""

from pyspark.sql import types as T

# They must equal what producers and stores already exchange.
EVENT_VERSION = "1.0"
PLAY_EVENT_TYPE = "recent_play"
TOP_TRACKS_EVENT_TYPE = "avd_artist_market_top_tracks"
DEFAULT_MARKET = "AT"
RECENT_LIMIT = 50
TOP_TRACKS = 10
GENRES = [
    "tech house", "drum and bass", "trance", "progressive house", "bass house", "dubstep",
    "future house", "progressive trance", "big room", "edm", "pop", "latin dance",
]
SEARCH_FALLBACKS = ["{} official", "best of {}", "{} mix"]
ANALYSIS_FIELDS = ["danceability", "energy", "tempo", "key", "mode", "valence"]
PROFILE_FEATURES = ["danceability", "popularity", "happiness", "liveness", "tempo"]
# End of fixed values.

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ARTIST = _struct(id=_S, name=_S)
ALBUM = _struct(id=_S, name=_S, release_date=_S, artists=T.ArrayType(ARTIST))
TRACK = _struct(id=_S, name=_S, duration_ms=_L, artists=T.ArrayType(ARTIST), album=ALBUM)

RECENT_ITEM = _struct(played_at=_S, track=TRACK)
RECENT_PLAYS = _struct(user_id=_S, country=_S, items=T.ArrayType(RECENT_ITEM))

ALBUM_PAGE = _struct(album_id=_S, offset=_L, limit=_L, total=_L, items=T.ArrayType(TRACK), next=_S)
ARTIST_TOP_TRACKS = _struct(artist_id=_S, market=_S, tracks=T.ArrayType(TRACK))

PLAYLIST = _struct(id=_S, name=_S, owner=_struct(id=_S), tracks=_struct(href=_S))
USER_PLAYLISTS = _struct(items=T.ArrayType(PLAYLIST))
PLAYLIST_ITEM = _struct(added_at=_S, is_local=T.BooleanType(), track=TRACK)
PLAYLIST_TRACKS = _struct(playlist_id=_S, playlist_name=_S, owner_id=_S,
                          items=T.ArrayType(PLAYLIST_ITEM))
SEARCH_RESULT = _struct(query=_S, playlists=_struct(items=T.ArrayType(_struct(id=_S, name=_S))))

PROFILE = _struct(id=_S, display_name=_S, country=_S)
ARTIST_META = _struct(id=_S, name=_S)

PLAY_EVENT = _struct(
    event_version=_S, event_type=_S, generated_at=_S,
    user_id=_S, country=_S, market_used=_S,
    played_at=_S, track_id=_S, track_name=_S, track_duration_ms=_L,
    album_id=_S, album_name=_S, album_release_date=_S,
    artist_ids=T.ArrayType(_S), artist_names=T.ArrayType(_S),
)

RANKED_TRACK = _struct(rank=T.IntegerType(), track_id=_S, track_name=_S, duration_ms=_L,
                       album_id=_S, album_name=_S, artists=T.ArrayType(_S))
TOP_TRACKS_DOCUMENT = _struct(
    event_version=_S, event_type=_S, generated_at=_S, user_id=_S, country=_S, market=_S,
    artist_id=_S, artist_name=_S, tracks=T.ArrayType(RANKED_TRACK),
)

MESSAGE = T.StructType([
    T.StructField("topic", _S), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", _L), T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", _S),
])

CATALOGUE = _struct(
    track_id=_S, artists=_S, album_name=_S, track_name=_S, popularity=T.IntegerType(),
    duration_ms=_L, explicit=T.BooleanType(), danceability=_D, energy=_D,
    key=T.IntegerType(), loudness=_D, mode=T.IntegerType(), speechiness=_D, acousticness=_D,
    instrumentalness=_D, liveness=_D, valence=_D, tempo=_D, time_signature=T.IntegerType(),
    track_genre=_S,
)
