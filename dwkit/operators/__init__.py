"""dwkit.operators"""
