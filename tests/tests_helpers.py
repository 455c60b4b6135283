RAW_SCHEMA = ("name string, release_date string, price string, user_score string, "
              "metacritic_score string, positive long, negative long, pct_pos_total double, "
              "categories string, genres string, tags string")
RAW_ROWS = [
    ("A", "2014-12-31", "$9.99", "85", "77", 10, 5, 66.7, "c", "g", "t"),
    ("B", "2015-01-01", "Free", "12.5%", "tbd", 0, 0, 0.0, None, None, None),
    ("C", "Coming soon", "1,299.50", None, "0", None, 3, None, "c", "g", "t"),
]
