"""dwkit.streaming"""
