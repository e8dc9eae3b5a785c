"""Plans: small driver-side specs (dicts / dataclasses) that drive DataFrame transformations."""
