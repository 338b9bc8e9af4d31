from reelstat.plans.cli import silver_media

if __name__ == "__main__":
    print("[silver_media] rows written:", silver_media())
