"""Text operators for building a training corpus from zone descriptions and other long texts of the land registry."""
