from .raw import DATASET_SIZES, dataset_folder, read_dataset, read_movies, read_ratings, read_users
from .sinks import (
    write_csv, write_id_mappings, write_metrics, write_parquet, write_training_triples,
)
from .tables import ids_frame, read_metrics, read_recommendations, read_split

__all__ = [
    "DATASET_SIZES", "dataset_folder", "ids_frame", "read_dataset", "read_metrics", "read_movies",
    "read_ratings", "read_recommendations", "read_split", "read_users", "write_csv",
    "write_id_mappings", "write_metrics", "write_parquet", "write_training_triples",
]
