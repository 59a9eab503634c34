"""Complete flows: trips, weather, features, profiles, and the bindings to the star-schema tables."""
