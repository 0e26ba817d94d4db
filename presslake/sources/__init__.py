"""presslake.sources"""
