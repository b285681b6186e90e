from .air import air_temperature
from .daily_max import daily_max_temperature, of_characteristics, published
from .daily_values import daily_value_stats
from .loggers import logger_folder_stats
from .portal import portal_stats
from .portal_json import portal_json_stats
from .submission import multi_part_submission_stats, submission_distribution, submission_stats

__all__ = [
    "air_temperature", "daily_max_temperature", "daily_value_stats", "logger_folder_stats",
    "multi_part_submission_stats", "of_characteristics", "portal_json_stats", "portal_stats", "published", "submission_distribution",
    "submission_stats",
]
