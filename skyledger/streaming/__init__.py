"""Running metrics and trips over message streams."""
