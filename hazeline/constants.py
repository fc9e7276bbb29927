"""Word lists, bounds, coefficients and lookup tables.

Everything here is plain data that results depend on. Operators take these as
default parameters; nothing below is logic.
"""

# PM2.5 upper limits of categories 0-4 and the category labels.
PM25_LIMITS = [12.0, 35.4, 55.4, 150.4, 250.4]
AQI_LABELS = ["Good", "Moderate", "USG", "Unhealthy", "Very Unhealthy", "Hazardous"]

# City centre, monitoring box and earth radius.
CENTER_LAT = 27.7172
CENTER_LON = 85.3240
BOX = {"lat_min": 27.60, "lat_max": 27.80, "lon_min": 85.20, "lon_max": 85.45}
EARTH_RADIUS_KM = 6371.0

# Feature window and lag definitions (hours / rows).
MEAN_WINDOWS_H = [1, 3, 6, 12, 24]
STD_WINDOWS_H = [1, 6, 24]
LAG_ROWS = [1, 3, 6, 12, 24, 48, 168]
PRECIP_WINDOW_H = 6
WEATHER_TOLERANCE_S = 3600

# Columns a weather match contributes to a reading.
WEATHER_COLUMNS = [
    "temp_c", "humidity_pct", "wind_speed_kmh", "wind_dir_sin", "wind_dir_cos",
    "precip_mm", "pressure_hpa", "precip_6h_cumulative",
]

# Pollutant names, in reading order.
POLLUTANTS = ["pm25", "pm10", "no2", "o3", "co"]

# Model inputs.
SEASONAL_REGRESSORS = [
    "temp_c", "humidity_pct", "wind_speed_kmh",
    "is_tihar", "is_dashain", "is_monsoon", "is_brick_kiln_season",
]
SEQUENCE_FEATURES = [
    "pm25", "pm10", "no2",
    "hour_sin", "hour_cos", "month_sin", "month_cos",
    "pm25_1h_mean", "pm25_3h_mean", "pm25_6h_mean", "pm25_12h_mean", "pm25_24h_mean",
    "pm25_1h_std", "pm25_6h_std", "pm25_24h_std",
    "pm25_lag_1h", "pm25_lag_3h", "pm25_lag_6h", "pm25_lag_12h", "pm25_lag_24h",
    "temp_c", "humidity_pct", "wind_speed_kmh", "wind_dir_sin", "wind_dir_cos",
    "precip_mm", "pressure_hpa",
    "is_tihar", "is_dashain", "is_monsoon", "is_pre_monsoon", "is_brick_kiln_season",
]
ANOMALY_FEATURES = ["pm25", "pm10", "no2", "pm25_1h_mean", "pm25_6h_mean"]
DRIFT_COLUMNS = ["pm25", "pm10", "temp_c", "humidity_pct", "wind_speed_kmh"]

# Thresholds.
PSI_WARNING = 0.2
PSI_RETRAIN = 0.25
EVENT_MULTIPLIER = 2.0
RMSE_DEGRADATION = 0.15
DEFAULT_LAST_VALUE = 50.0
HAZARD_PM25 = 300.0
IMPOSSIBLE_PM25 = 999.0
BLEND_WEIGHTS = (0.4, 0.6)
LATENCY_BUCKETS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]

# Validation bounds (inclusive) and allowed sources.
READING_BOUNDS = {
    "pm25": (0.0, 999.9), "pm10": (0.0, 2000.0), "no2": (0.0, 500.0),
    "o3": (0.0, 600.0), "co": (0.0, 100.0), "aqi_us": (0.0, 500.0),
    "lat": (20.0, 35.0), "lon": (80.0, 90.0),
}
WEATHER_BOUNDS = {
    "lat": (20.0, 35.0), "lon": (80.0, 90.0),
    "temp_c": (-20.0, 50.0), "humidity_pct": (0.0, 100.0),
    "wind_speed_kmh": (0.0, 200.0), "wind_dir_deg": (0.0, 360.0),
    "precip_mm": (0.0, 500.0), "pressure_hpa": (700.0, 1100.0),
}
TRAINING_BOUNDS = {
    "pm25_24h_mean": (0.0, 999.9), "pm25_lag_1h": (0.0, 999.9),
    "temp_c": (-20.0, 50.0), "humidity_pct": (0.0, 100.0),
}
ALLOWED_SOURCES = ["openaq", "aqicn", "kriging_interpolated", "integration_test"]

# Plain-language names of model features.
FEATURE_DESCRIPTIONS = {
    "is_tihar": "Tihar festival fireworks",
    "is_dashain": "Dashain traffic surge",
    "is_brick_kiln_season": "Brick kiln operations",
    "is_monsoon": "Monsoon season (dust suppression)",
    "is_pre_monsoon": "Pre-monsoon dry conditions",
    "temp_c": "Temperature",
    "humidity_pct": "Humidity level",
    "wind_speed_kmh": "Wind speed",
    "pm25_lag_24h": "Yesterday's PM2.5 level",
    "pm25_24h_mean": "24-hour rolling average",
    "precip_mm": "Precipitation (rain washout)",
    "pressure_hpa": "Atmospheric pressure (inversion)",
}

# Ward id, latitude, longitude.
WARDS = [
    (1, 27.7150, 85.3100), (2, 27.7100, 85.3050), (3, 27.7120, 85.3150), (4, 27.7200, 85.3180),
    (5, 27.7080, 85.3200), (6, 27.7050, 85.3250), (7, 27.7000, 85.3300), (8, 27.6980, 85.3350),
    (9, 27.7250, 85.3050), (10, 27.7300, 85.3100), (11, 27.7180, 85.3280), (12, 27.7220, 85.3350),
    (13, 27.7270, 85.3400), (14, 27.7350, 85.3200), (15, 27.7400, 85.3250), (16, 27.7050, 85.3400),
    (17, 27.7100, 85.3450), (18, 27.6950, 85.3150), (19, 27.6900, 85.3200), (20, 27.6850, 85.3250),
    (21, 27.6800, 85.3300), (22, 27.6750, 85.3350), (23, 27.6700, 85.3400), (24, 27.6650, 85.3450),
    (25, 27.6600, 85.3200), (26, 27.6550, 85.3300), (27, 27.7150, 85.2950), (28, 27.7200, 85.2900),
    (29, 27.7100, 85.2850), (30, 27.7050, 85.2800), (31, 27.7000, 85.2750), (32, 27.6950, 85.2700),
]
WARD_NAME = "Kathmandu Ward {}"

# First days of the long festivals (their lengths give the other
# days), one-day festivals, and holidays as same-day-every-year or moving dates.
DASHAIN_DAYS = 15
DASHAIN_STARTS = ["2020-10-17", "2021-10-07", "2022-09-26", "2023-10-15",
                  "2024-10-03", "2025-09-22", "2026-10-11", "2027-10-01"]
TIHAR_DAYS = 5
TIHAR_STARTS = ["2020-11-14", "2021-11-02", "2022-10-24", "2023-11-12",
                "2024-11-01", "2025-10-20", "2026-11-08", "2027-10-29"]
INDRA_JATRA = ["2020-09-01", "2021-09-18", "2022-09-07", "2023-09-28",
               "2024-09-16", "2025-09-05", "2026-09-24", "2027-09-14"]
YEARLY_HOLIDAYS = {"01-01": "New Year", "01-29": "Martyrs Day", "02-19": "National Democracy Day",
                   "04-14": "Nepali New Year", "05-29": "Republic Day"}
HOLIDAY_YEARS = (2020, 2027)
MOVING_HOLIDAYS = {
    "Prithvi Narayan Shah Jayanti": ["2020-01-11", "2021-01-11"],
    "Maghe Sankranti": ["2021-01-15", "2022-01-14", "2023-01-15", "2024-01-15", "2025-01-14",
                        "2026-01-14", "2027-01-14"],
    "Maha Shivaratri": ["2020-03-10", "2021-03-11", "2022-03-01", "2023-02-18", "2024-03-08",
                        "2025-02-26", "2026-02-15", "2027-03-06"],
    "International Women's Day": ["2020-03-08"],
    "Holi": ["2020-03-10", "2021-03-29", "2022-03-18", "2023-03-07", "2024-03-25", "2025-03-14",
             "2026-03-04", "2027-03-22"],
    "Ghode Jatra": ["2020-03-29"],
    "Buddha Jayanti": ["2020-05-07", "2021-05-26", "2022-05-16", "2023-05-05", "2024-05-23",
                       "2025-05-12", "2026-05-01", "2027-05-20"],
    "Janai Purnima": ["2020-08-03", "2021-08-22", "2022-08-12", "2023-08-31", "2024-08-19",
                      "2025-08-09", "2026-08-28", "2027-08-17"],
    "Tamu Lhosar": ["2020-12-30"],
}
