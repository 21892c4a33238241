"""
operators themselves follow the reference (top 10, top 3, sample 100,
threshold 100, 60 min); the fixture values below fit the driver data."""

RANGE_START, RANGE_END = "2024-01-05", "2024-01-20"
FILTER = dict(start_age=20, end_age=50, sex="male",
              professionals=["BUILDING", "MACHINERY"], keywords=["kw1", "kw3", "kw5"])
FILTER_AGE_ONLY = dict(start_age=20, end_age=50)
FILTER_PLACES = dict(cities=["NATION_1", "NATION_4", "NATION_7", "NATION_12"], category_ids=[3, 14, 15, 92])
SAMPLE_TOTAL, SAMPLE_SEED = 3000, 42
TOP_CATEGORIES, TOP_SESSIONS = 10, 10
PAGE_FLOW = "1,2,3,4,5,6,7"
TOP_PRODUCTS = 3
AD_THRESHOLD = 2
TOP_ADS = 3
WINDOW_MINUTES, SLIDE_MINUTES = 60, 1
AS_OF_DAY = "2024-01-15"
SPLIT_TS = "2024-01-15 12:00:00"
STREAM_BATCHES = 4
AREA_LEVELS = {"AFRICA": "A_Level", "AMERICA": "A_Level", "ASIA": "B_Level", "EUROPE": "C_Level"}
