"""Jobs over the two feeds and analyses over their tables."""
