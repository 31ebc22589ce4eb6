"""The layers: cleaning, dimensional mart, features and serving result sets."""
