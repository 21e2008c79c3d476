"""Words and column names shared by all modules."""

# Alias lists in order of priority. Input files may use any of them.
VEHICLE_ID = ("id_vehiculo", "carro_id", "vehiculo_id", "idvehiculo", "carroid")
RATING = ("calificacion", "estrellas", "rating", "score")
RATING_DATE = ("creado_en", "fecha", "created_at", "datetime", "ts")
REVIEW_DATE = ("fecha", "creado_en", "created_at", "datetime", "ts")
USER = ("usuario", "username", "user", "author")
REVIEW_TEXT = ("resena", "comentario", "texto", "review", "coment")
CATALOGUE_ID = ("id_vehiculo", "vehiculo", "id_auto", "id")
CATALOGUE_BRAND = ("marca", "brand", "fabricante", "make")
CATALOGUE_NAME = (
    "nombre_vehiculo", "nombre", "modelo", "vehiculo_nombre", "description", "descripcion",
)
SCORE_ID = ("id_vehiculo", "vehiculo", "modelo")
SCORE_BRAND = ("marca", "brand", "fabricante", "maker")
SCORE_MEAN = ("promedio_calificacion", "rating_promedio", "avg_rating")
SCORE_REVIEWS = ("n_resenas", "resenas", "reviews")
SCORE_RATINGS = ("n_calificaciones", "calificaciones", "votes")
STORED_STAR = ("calificacion", "estrellas", "rating", "star")
STORED_STAR_COUNT = ("n", "count", "total")
STORED_MONTH = ("ym", "mes", "month")
STORED_MONTH_COUNT = ("n_calif", "n", "count", "total")
STORED_DAY = ("fecha_d", "fecha", "date", "dia")
STORED_REVIEW_COUNT = ("n_resenas", "n", "count")
STORED_USER = ("usuario", "username", "user")

# Parts of column names that identify a column in a stored table.
LABEL_TOKENS = ("vehiculo", "vehículo", "vehicle", "modelo", "nombre")
MEAN_TOKENS = ("promedio", "rating")
REVIEW_COUNT_TOKENS = ("resenas", "reseñas")
STAR_TOKENS = ("estrella",)
DATE_PREFIXES = ("fecha",)
COMMENT_TOKENS = ("coment",)

# Words that appear in results or are accepted as parameters.
UNKNOWN_LABEL = "Desconocido"
ID_LABEL_PREFIX = "ID "
DEFAULT_LABEL = "Vehículo"
NO_STATUS = "N/A"
BEST, WORST, MOST_REVIEWED, LEAST_REVIEWED = "mejor", "peor", "mas_resenas", "menos_resenas"
ASCENDING = "asc"
