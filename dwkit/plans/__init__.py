"""dwkit.plans"""
