from shopflow.sources.tables import read_table
from shopflow.sources.fixtures import (
    ad_log, city_area, events, product_info, user_info, user_visit_action)
from shopflow.sources.adlog import parse_ad_log

__all__ = ["read_table", "events", "user_visit_action", "user_info",
           "product_info", "city_area", "ad_log", "parse_ad_log"]
