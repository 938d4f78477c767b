"""Features, models, recommendations and the reports built from them."""
