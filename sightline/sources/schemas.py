"""Explicit schemas of the five raw tables (free text stays text until cleaning)."""

SCHEMAS = {
    "sightings": (
        "datetime string, city string, state string, country string, shape string, "
        "duration_seconds string, duration_hours_min string, comments string, "
        "date_posted string, latitude string, longitude string"
    ),
    "weather": (
        "formatted_date timestamp_ntz, summary string, precip_type string, temperature_c double, "
        "apparent_temperature_c double, humidity double, wind_speed_km double, "
        "wind_bearing_degrees double, visibility_km double, loud_cover double, "
        "pressure_millibars double, daily_summary string"
    ),
    "crashes": (
        "date string, time string, location string, operator string, flight_number string, "
        "route string, type string, registration string, cn_ln string, aboard int, "
        "fatalities int, ground int, summary string"
    ),
    "coordinates": (
        "country_code string, latitude double, longitude double, country string, "
        "usa_state_code string, usa_state_latitude double, usa_state_longitude double, "
        "usa_state string"
    ),
    "flights": (
        "index bigint, airline string, flight string, source_city string, departure_time string, "
        "stops string, arrival_time string, destination_city string, class string, "
        "duration double, days_left int, price double"
    ),
}
