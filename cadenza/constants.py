"""Column lists, category tables and thresholds the results depend on."""

# The seven core audio features of a track.
CORE_FEATURES = [
    "danceability",
    "energy",
    "loudness",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "valence",
]

# Derived features used by the models.
MODEL_FEATURES = [
    "Dance_Energy_Interaction",
    "Valence_Energy_Ratio",
    "Acoustic_Instrumental_Interaction",
    "Speechiness_Energy_Ratio",
]

# Derived features of the cleaned catalogue.
CATALOGUE_FEATURES = [
    "Dance_Energy_Interaction",
    "Loudness_Duration_Ratio",
    "Tempo_vs_120",
    "Valence_Energy_Ratio",
]

# Columns kept in the reduced catalogue, by importance.
REDUCED_METADATA = ["artist_name", "track_name", "track_id", "genre", "popularity"]
REDUCED_FEATURES = [
    "year",
    "duration_ms",
    "acousticness",
    "instrumentalness",
    "loudness",
    "danceability",
    "energy",
    "valence",
    "liveness",
    "Valence_Energy_Ratio",
    "Dance_Energy_Interaction",
    "tempo",
    "Tempo_vs_120",
    "key",
]

# Columns filled with their mean / their mode.
MEAN_FILL_COLUMNS = [
    "Popularity",
    "Year",
    "Danceability",
    "Energy",
    "Loudness",
    "Speechiness",
    "Acousticness",
    "Instrumentalness",
    "Liveness",
    "Valence",
    "Tempo",
    "Duration_ms",
]
MODE_FILL_COLUMNS = ["Key", "Mode", "Time_signature"]

# Columns a catalogue must have to pass validation.
REQUIRED_COLUMNS = [
    "artist_name",
    "track_name",
    "genre",
    "danceability",
    "energy",
    "acousticness",
    "instrumentalness",
    "loudness",
    "liveness",
    "valence",
    "tempo",
    "key",
    "year",
    "duration_ms",
]

# Genre -> category.
GENRE_MAP = {
    "pop": "POP",
    "power-pop": "POP",
    "pop-film": "POP",
    "cantopop": "POP",
    "k-pop": "POP",
    "indie-pop": "POP",
    "alt-rock": "ROCK",
    "rock-n-roll": "ROCK",
    "hard-rock": "ROCK",
    "psych-rock": "ROCK",
    "rock": "ROCK",
    "punk-rock": "ROCK",
    "punk": "ROCK",
    "metal": "ROCK",
    "heavy-metal": "ROCK",
    "death-metal": "ROCK",
    "black-metal": "ROCK",
    "metalcore": "ROCK",
    "goth": "ROCK",
    "emo": "ROCK",
    "hardcore": "ROCK",
    "industrial": "ROCK",
    "garage": "ROCK",
    "hip-hop": "HIP-HOP",
    "dance": "DANCE",
    "samba": "DANCE",
    "salsa": "DANCE",
    "forro": "DANCE",
    "tango": "DANCE",
    "disco": "DANCE",
    "dancehall": "DANCE",
    "ska": "DANCE",
    "groove": "DANCE",
    "party": "DANCE",
    "classical": "CLASSICAL",
    "opera": "CLASSICAL",
    "piano": "CLASSICAL",
    "jazz": "JAZZ",
    "blues": "JAZZ",
    "country": "COUNTRY",
    "sertanejo": "COUNTRY",
    "folk": "COUNTRY",
    "singer-songwriter": "COUNTRY",
    "songwriter": "COUNTRY",
    "indian": "DESI",
    "ambient": "ELECTRONIC",
    "deep-house": "ELECTRONIC",
    "trance": "ELECTRONIC",
    "electronic": "ELECTRONIC",
    "techno": "ELECTRONIC",
    "house": "ELECTRONIC",
    "chicago-house": "ELECTRONIC",
    "detroit-techno": "ELECTRONIC",
    "minimal-techno": "ELECTRONIC",
    "club": "ELECTRONIC",
    "drum-and-bass": "ELECTRONIC",
    "breakbeat": "ELECTRONIC",
    "hardstyle": "ELECTRONIC",
    "electro": "ELECTRONIC",
    "trip-hop": "ELECTRONIC",
    "dubstep": "ELECTRONIC",
    "dub": "ELECTRONIC",
    "edm": "ELECTRONIC",
    "progressive-house": "ELECTRONIC",
    "new-age": "ELECTRONIC",
    "chill": "ELECTRONIC",
    "sleep": "ELECTRONIC",
}

# Genres removed from the catalogue.
DROPPED_GENRES = [
    "gospel",
    "acoustic",
    "comedy",
    "spanish",
    "french",
    "german",
    "swedish",
    "show-tunes",
    "soul",
    "romance",
    "sad",
    "guitar",
    "funk",
    "grindcore",
    "afrobeat",
]

# Labels shown to users.
UNKNOWN_GENRE = "UNKNOWN_GENRE"
CLUSTER_NAMES = ["AI cluster: High Energy", "AI cluster: Chill Vibes"]

# Accepted column aliases of served and uploaded tables.
COLUMN_ALIASES = {
    "title": "track_name",
    "artists": "artist_name",
    "id": "track_id",
    "song url": "song_url",
}

# Defaults of sampling, splitting and validation.
SEED = 42
TEST_FRACTION = 0.2
MIN_CLASS_ROWS = 10
MAX_MISSING_PERCENT = 50.0
MAX_DUPLICATE_FRACTION = 0.1
MAX_OUTLIER_FRACTION = 0.05
OUTLIER_IQR_FACTOR = 3.0
MIN_ACCURACY = 0.5
RATIO_EPSILON = 1e-6
